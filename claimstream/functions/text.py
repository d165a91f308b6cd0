"""Text expressions: normalising, word n-grams, entity redaction."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a token may hold, and the mark that replaces an entity.
NOT_TOKEN_CHARACTER = r"(?U)[^\p{L}\p{N}_\s<>]"
WHITESPACE = r"(?U)\s+"
ENTITY_MARK = "<ENTITY>"

# A character that hardly any text has: it stands for the entities already found in a text.
STAND_IN = "\ue000"

# Default entity rule: one or more capitalised words in a row, or a number.
ENTITY_PATTERN = r"\p{Lu}[\p{L}\p{N}]+(?: \p{Lu}[\p{L}\p{N}]+)*|[0-9]+"


def tokens(text: Column) -> Column:
    """Lower-case words without punctuation; empty tokens are dropped."""
    kept = F.regexp_replace(F.lower(text), NOT_TOKEN_CHARACTER, "")
    return F.filter(F.split(kept, WHITESPACE), lambda word: word != "")


def joined_tokens(text: Column) -> Column:
    """The tokens of a text with one space between them, for texts that are cut more than once."""
    return F.array_join(tokens(text), " ")


def split_joined(joined: Column) -> Column:
    """What ``tokens`` gave, from what ``joined_tokens`` made of it."""
    return F.when(joined != "", F.split(joined, " ")).when(joined == "", F.array().cast("array<string>"))


def word_ngrams(
    df: DataFrame,
    keep: Sequence[str],
    text: Column,
    n: int = 3,
    out: str = "pattern",
    short: bool = False,
    words: Callable[[Column], Column] = tokens,
) -> DataFrame:
    """One row per word n-gram of ``text``, repeats included, next to the ``keep`` columns.

    With ``short`` a text of fewer words, but not none, gives all its words as one n-gram.
    ``words`` cuts the text: ``split_joined`` where ``joined_tokens`` made it.

    The words are exploded once and each reads its followers from the token array,
    so the whole step stays in generated code.  The outer explode keeps the optimizer
    from adding a second tokenisation as an inferred non-empty filter.
    """
    words = df.select(*keep, words(text).alias("_tokens")).select(
        *keep, "_tokens", F.posexplode_outer("_tokens").alias("_pos", "_word")
    )
    followers = [F.get("_tokens", F.col("_pos") + i) for i in range(1, n)]
    last = F.size("_tokens") - n
    return words.where(F.col("_pos") <= (F.greatest(last, F.lit(0)) if short else last)).select(
        *keep, F.concat_ws(" ", "_word", *followers).alias(out)
    )


def choose_text(redacted: Column, claim: Column) -> Column:
    """The redacted text when there is one, else the claim."""
    return F.coalesce(F.nullif(redacted, F.lit("")), claim)


def find_entities(text: Column, pattern: str = ENTITY_PATTERN) -> Column:
    """Distinct entities of a text by a rule; a caller may use any array column instead."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def redact(text: Column, entities: Column) -> Column:
    """Replace every occurrence of each entity, the longest entity first.

    Entities of one length go in alphabetical order; null and empty ones are passed over.
    Each entity in turn becomes a character the text does not have, which becomes the mark at the
    end, so that a short entity such as "E" cannot rewrite the letters of a mark.  A text that
    has the character itself is cut at each entity and joined with marks instead.
    """
    named = F.filter(entities, lambda e: e.isNotNull() & (e != ""))
    ordered = F.transform(
        F.sort_array(F.transform(named, lambda e: F.struct(-F.length(e), e.alias("entity")))),
        lambda pair: pair["entity"],
    )
    none = F.array().cast("array<string>")
    ordered = F.coalesce(ordered, none)

    def cut_at(parts: Column, entity: Column) -> Column:
        literal = F.concat(
            F.lit(r"\Q"), F.replace(entity, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")
        )
        return F.flatten(F.transform(parts, lambda part: F.split(part, literal, -1)))

    stand_in = F.lit(STAND_IN)
    parts = F.aggregate(ordered, F.array(text), cut_at)
    # An entity with the character is not in the text, and must not arise there.
    possible = F.filter(ordered, lambda e: ~F.contains(e, stand_in))
    replaced = F.aggregate(possible, text, lambda done, e: F.replace(done, e, stand_in))
    return F.when(F.contains(text, stand_in), F.array_join(parts, ENTITY_MARK)).when(
        text.isNotNull(), F.replace(replaced, stand_in, F.lit(ENTITY_MARK))
    )


def redact_by_rule(text: Column, pattern: str = ENTITY_PATTERN) -> Column:
    """``redact`` with the entities of ``find_entities``, in one pass over the text.

    Whatever an entity of the rule occurs in is itself a match of the rule, and a match is as long
    as it can be, so replacing the matches replaces every occurrence, the longest first.
    """
    return F.regexp_replace(text, pattern, ENTITY_MARK)
