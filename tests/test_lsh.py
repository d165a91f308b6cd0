import hashlib
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from claimstream.functions.hashing import HASH_RANGE, PRIME, permutation
from claimstream.functions.text import joined_tokens, split_joined, tokens
from claimstream.operators import lsh, patterns
from claimstream.operators.spread import spread_lookup


def make_claims(seed=3):
    draw = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = [draw.choice(vocab) for _ in range(40)]
        for _ in range(draw.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2])):
                copy[draw.randrange(40)] = draw.choice(vocab)
            texts.append(" ".join(copy))
    draw.shuffle(texts)
    return [(i, t) for i, t in enumerate([*texts, "a b", "", "a b"])]


def brute(rows):
    """Each claim with all earlier claims that agree on a band, from the signatures."""
    similar = {}
    for i, mine in rows.items():
        found = sorted(
            j
            for j, other in rows.items()
            if j < i and any(mine[b * 8 : b * 8 + 8] == other[b * 8 : b * 8 + 8] for b in range(8))
        )
        if found:
            similar[i] = found
    return similar


def test_bands_of_the_default_threshold():
    assert lsh.bands_for(0.7, 64) == (8, 8)


def test_links_clusters_and_lists_equal_brute_force(spark):
    claims = spark.createDataFrame(make_claims(), "id bigint, text string").repartition(5)
    signed = lsh.signatures(claims, "id", F.col("text"))
    rows = {r.id: r.signature for r in signed.collect()}
    texts = dict(make_claims())
    assert sorted(rows) == sorted(i for i, t in texts.items() if t.split())
    similar = brute(rows)
    links = lsh.bucket_links(claims, "id", F.col("text")).checkpoint()

    nearest = {r.id: r.cluster_id for r in lsh.nearest(links, "id").collect()}
    assert nearest == {i: found[0] for i, found in similar.items()}

    listed = lsh.similar_to(links, claims, "id")
    assert sorted((r.id, r.similar_id) for r in listed.collect()) == sorted(
        (i, j) for i, found in similar.items() for j in found
    )

    got = lsh.clusters(links, "id")
    assert sorted((r.cluster_id, r.id) for r in got.collect()) == sorted(
        (found[0], i) for i, found in similar.items()
    )
    asked = got.select("cluster_id").distinct().where("cluster_id % 2 = 0")
    expected = set()
    for i, found in similar.items():
        if found[0] % 2 == 0:
            expected.add((found[0], i))
            expected.update((found[0], j) for j in found[1:])
    members = [(r.cluster_id, r.id) for r in lsh.cluster_members(links, asked, "id").collect()]
    assert len(members) == len(set(members)) and set(members) == expected

    shown = lsh.similar_claims(links, claims, "id", "text")
    for r in lsh.nest_similar(shown, "id").collect():
        ids = [e["id"] for e in r.similar_claims]
        assert ids[0] == similar[r.id][0] and set(ids) <= set(similar[r.id])
        assert r.claim_text == texts[r.id]
        assert all(e["text"] == texts[e["id"]] for e in r.similar_claims)


def test_signature_agreement_follows_jaccard(spark):
    claims = spark.createDataFrame(make_claims(), "id bigint, text string")
    rows = {r.id: r.signature for r in lsh.signatures(claims, "id", F.col("text")).collect()}

    def grams(text):
        words = re.sub(r"[^\w\s<>]", "", text.lower()).split()
        return {" ".join(words[i : i + 3]) for i in range(len(words) - 2)}

    texts = dict(make_claims())
    for i in list(rows)[:40]:
        for j in rows:
            a, b = grams(texts[i]), grams(texts[j])
            same = sum(x == y for x, y in zip(rows[i], rows[j])) / 64
            assert abs(same - len(a & b) / len(a | b)) < 0.3


def test_one_text_copied_into_a_third_of_the_table(spark):
    rows = [(i, "the very same words again") for i in range(600)]
    rows += [(600 + i, f"other words {i} and {i * 7} more") for i in range(1200)]
    claims = spark.createDataFrame(rows, "id bigint, text string").withColumn("batch", F.lit(1))
    links = lsh.bucket_links(claims, "id", F.col("text"), scope=["batch"]).checkpoint()
    assert links.count() <= 8 * 1800
    got = lsh.clusters(links, "id", ["batch"]).where("id < 600")
    assert got.count() == 599
    total = lsh.summary(claims, links, "id", ["batch"], F.lit(1)).first()
    assert (total.row_count, total.positive_count) == (1800, 1800)
    assert total.similar_count >= 599


def test_overlapping_buckets_give_one_row_per_claim(spark):
    """Claims share one bucket, and each has an earlier similar claim of its own in another."""
    m = 400
    rows = [(0, 1000, 1000 + i) for i in range(m)]
    rows += [(1, i, x) for i in range(m) for x in (i, 1000 + i)]
    links = spark.createDataFrame(rows, "band int, first_id bigint, id bigint")
    assert lsh.clusters(links, "id").count() == m
    one = spark.createDataFrame([(7,)], "cluster_id bigint")
    members = lsh.cluster_members(links, one, "id")
    assert sorted(r.id for r in members.collect()) == [*range(1000, 1008)]


def test_scope_keeps_batches_apart(spark):
    rows = [(1, "a", "one two three four"), (2, "b", "one two three four"), (3, "a", "one two three four"), (4, None, "one two three four"), (5, None, "one two three four")]
    claims = spark.createDataFrame(rows, "id bigint, batch string, text string")
    links = lsh.bucket_links(claims, "id", F.col("text"), ["batch"])
    assert [(r.batch, r.id, r.cluster_id) for r in lsh.nearest(links, "id", ["batch"]).orderBy("id").collect()] == [("a", 3, 1), (None, 5, 4)]


def test_spread_lookup_equals_a_join(spark):
    big = spark.range(2000).select("id", F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 50).alias("k"))
    small = spark.createDataFrame([(1, "x"), (1, "y"), (7, "z")], "k bigint, v string")
    expected = big.join(small, "k").select("id", "k", "v")
    got = spread_lookup(big, small, ["k"], "id").select("id", "k", "v")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_signature_of_a_claim_longer_than_a_batch(spark):
    words = [f"w{i * i % 5003}" for i in range(25_000)]
    claims = spark.createDataFrame([("s", 1, " ".join(words)), ("t", 1, "one two"), ("t", 2, None)], "scope string, id int, claim string")
    signed = lsh.signatures(claims, "id", F.col("claim"), ["scope"], permutations=5)
    grams = {"s": {" ".join(words[k : k + 3]) for k in range(len(words) - 2)}, "t": {"one two"}}
    hashes = {s: [int(hashlib.md5(g.encode()).hexdigest()[:7], 16) for g in them] for s, them in grams.items()}
    drawn = [permutation(i) for i in range(5)]
    assert {(r.scope, r.id, *r.signature) for r in signed.collect()} == {
        (s, 1, *(min((a * h + b) % PRIME for h in hashes[s]) for a, b in drawn)) for s in "st"
    }
    # The permuted hashes are taken in arrays, before any aggregate.
    assert "MapInArrow" in signed._jdf.queryExecution().executedPlan().toString()


def test_joined_tokens_give_the_same_words_signatures_and_counts(spark):
    """Texts cut once and joined are not cut by rule again, and nothing else changes."""
    odd = [None, "", " \t", "...", "One,  two THREE four", "a b", "<X> _y 1.5\nz", "a b c a b c a b c"]
    docs = spark.createDataFrame(list(enumerate(odd)), "id int, text string").withColumn(
        "joined", joined_tokens(F.col("text"))
    )
    assert docs.where(~split_joined(F.col("joined")).eqNullSafe(tokens(F.col("text")))).count() == 0
    made = docs.select("id", "text", "joined").localCheckpoint()
    read = [
        lambda text, **words: lsh.signatures(made, "id", F.col(text), **words),
        lambda text, **words: patterns.pattern_record(made.withColumn("g", F.lit(0)), F.col(text), ["g"], 5, **words),
    ]
    for of in read:
        joined = of("joined", words=split_joined)
        assert "regexp_replace" not in joined._jdf.queryExecution().analyzed().toString()
        assert sorted(map(str, joined.collect())) == sorted(map(str, of("text").collect()))


def test_permuted_minima_are_exact_at_the_ends_of_their_range():
    drawn = [(1, PRIME - 5), (1, 0), (PRIME - 1, PRIME - 1), (PRIME - 1, 0), permutation(3)]
    rows, hashes = [0, 0, 0, 1, 2, 2], [5, 4, 6, 0, HASH_RANGE - 1, HASH_RANGE - 2]
    batch = pa.RecordBatch.from_pydict({"id": [7, 7, 7, 8, 9, 9], "_row": rows, "_hash": hashes})
    (got,) = lsh._minima(iter([batch]), drawn)
    expected = [
        [min((a * h + b) % PRIME for r, h in zip(rows, hashes) if r == row) for a, b in drawn] for row in range(3)
    ]
    assert got.to_pydict() == {"id": [7, 8, 9], "_minima": expected}
