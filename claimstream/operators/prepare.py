"""From labelled corpus lines to clean, redacted claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstream.functions.text import redact, redact_by_rule, tokens
from claimstream.operators.spread import spread_lookup
from claimstream.session import cut

# The corpus labels and the class each one stands for.
LABEL_CLASS = {"SUPPORTS": 0, "REFUTES": 1, "NOT ENOUGH INFO": 1}

WORD = r"(?U)[\p{L}\p{N}]+"

# The words of a dictionary are copied so often where they are not broadcast: frequent words spread.
SLICES = 8


def label_class(label: Column) -> Column:
    """0 or 1 for a known corpus label, null for any other."""
    out = F.lit(None).cast("int")
    for name, value in LABEL_CLASS.items():
        out = F.when(label == name, F.lit(value)).otherwise(out)
    return out


def prepare_claims(raw: DataFrame, entities: Column | None = None) -> DataFrame:
    """Drop incomplete and unknown rows, map the label, redact the entities.

    ``entities`` is any array column: a rule (the default), a dictionary match
    (``dictionary_entities``) or a caller's own extractor.
    """
    claim = F.col("claim")
    redacted = redact_by_rule(claim) if entities is None else redact(claim, entities)
    return (
        raw.where(F.col("claim").isNotNull() & F.col("label").isNotNull())
        .withColumn("label", label_class(F.col("label")))
        .where(F.col("label").isNotNull())
        .select(
            "claim",
            redacted.alias("entity_redacted_claim"),
            "label",
        )
    )


def unreadable(raw: DataFrame) -> DataFrame:
    """Corpus lines that are no JSON, as they stand; ``prepare_claims`` leaves them out.

    Such a line has no claim; asking for that too lets the reader give the line by itself.
    """
    broken = F.col("_corrupt_record").isNotNull() & F.col("claim").isNull()
    return raw.where(broken).select(
        F.col("_corrupt_record").alias("line")
    )


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def name_index(names: DataFrame, uses: DataFrame) -> DataFrame:
    """(word, name, at): every name under its rarest word, and where in the name that word stands.

    ``names`` has one column, ``entity``; ``uses`` has (word, uses) of the texts.  A word no text has
    is the rarest.  Of words alike in that the first in the alphabet is taken.
    """
    wanted = names.select(_words(F.col("entity")).alias("name")).where(F.size("name") > 0).distinct()
    each = wanted.select("name", F.posexplode("name").alias("at", "word"))
    ranked = each.join(uses, "word", "left").groupBy("name").agg(
        F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "word", "at")).alias("_rarest")
    )
    return ranked.select("_rarest.word", "name", "_rarest.at")


def dictionary_entities(claims: DataFrame, names: DataFrame, id: str, text: str) -> DataFrame:
    """Entities of each text that stand in a dictionary, as (id, entities).

    ``names`` has one column, ``entity``.  Names and texts are cut into words by one rule, so
    punctuation and spacing do not matter; of a match the text's own spelling is listed.

    A name is looked up by its rarest word alone, wherever a text has that word, and compared
    there: the length of a name costs nothing where its rarest word is missing.  Only words that some
    name has leave their text, with their places, so what is looked up grows with the matches and not
    with the texts.  A text and the places of the names it may hold meet once.
    """
    texts = claims.select(
        id, _words(F.col(text)).alias("_words"), F.split(text, WORD, -1).alias("_gaps")
    )
    # The outer explode keeps the optimizer from cutting every text a second time.
    placed = texts.select(id, F.posexplode_outer("_words").alias("place", "word"))
    placed = placed.withColumn("_slice", F.pmod(F.xxhash64(id), F.lit(SLICES)))
    named = names.select(F.explode(_words(F.col("entity"))).alias("word")).distinct()
    copies = named.select("word", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)).cast("array<bigint>")).alias("_slice"))
    listed = cut(placed.join(copies, ["word", "_slice"], "left_semi").drop("_slice"))
    uses = listed.groupBy("word").agg(F.count("*").alias("uses"))
    index = name_index(names, uses)
    maybe = spread_lookup(listed, index, ["word"], id).where("place >= at")
    asked = maybe.groupBy(id).agg(
        F.collect_set(F.struct((F.col("place") - F.col("at")).alias("start"), "name")).alias("_names")
    )

    def stands(name: Column) -> Column:
        return F.slice("_words", name["start"] + 1, F.size(name["name"])) == name["name"]

    def spelled(name: Column) -> Column:
        start, n = name["start"], F.size(name["name"])
        parts = F.transform(
            F.slice("_words", start + 1, n),
            lambda word, j: F.when(j == 0, word).otherwise(F.concat(F.get("_gaps", start + j), word)),
        )
        return F.array_join(parts, "")

    entities = F.array_distinct(F.transform(F.filter("_names", stands), spelled))
    return texts.join(asked, id).select(id, entities.alias("entities")).where(F.size("entities") > 0)


def text_sizes(df: DataFrame, id: str, text: str, n: int = 3) -> DataFrame:
    """Words and word n-grams of each text."""
    words = F.coalesce(F.size(tokens(F.col(text))), F.lit(0))
    return df.select(id, words.alias("n_tokens")).withColumn(
        "n_shingles", F.greatest(F.col("n_tokens") - (n - 1), F.lit(0))
    )
