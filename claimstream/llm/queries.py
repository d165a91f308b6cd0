"""The registered queries of the operators, and their SQL twins for DuckDB."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstream.llm import (
    automaton,
    bwt,
    chosenpath,
    exact,
    language,
    mixing,
    pages,
    periodic,
    phrases,
    quality,
    recompression,
    sharding,
    simhash,
)
from claimstream.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHARDS = 24
PHRASES = 2000


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 contiguous shards of near-equal bytes."""
    placed = sharding.assign(table(spark, folder, "documents"), "doc_id", "text", SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the document of its text that stays."""
    hashed = exact.digests(table(spark, folder, "documents"), "doc_id", "text")
    # Texts the refinement told apart early have no full hash yet; the result asks for it.
    hashed = hashed.withColumn(
        "text_sha256", F.coalesce("digest", F.sha2(F.col("_text").cast("binary"), 256))
    ).drop("_text")
    return exact.groups(hashed, "doc_id", ("text_sha256",))


@query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), "doc_id", "text")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the words that stand in 13-word windows of earlier ones."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    left = recompression.removed(docs, "doc_id", "text")
    kept = F.sha2(F.col("kept").cast("binary"), 256)
    return left.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; learned from labelled rows that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    open_rows = labels.where(~held_out(F.col("doc_id")))
    machine = quality.train(docs, open_rows, "doc_id", "text", "quality")
    scored = quality.scored(docs.select("doc_id", "text"), "text", machine)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"),
    )


@query
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words the mix takes of it, and its source's target."""
    docs = table(spark, folder, "documents")
    size, members = mixing.word_count(F.col("text")), F.array("source")
    mixed, _ = mixing.mixed(docs, "doc_id", size, members)
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


@query
def op7_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    given = table(spark, folder, "pages").select("page_id", "url", "html")
    found = pages.extracted(given, "html", pages.train(given, "page_id", "html"))
    return found.select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )


@query
def op8_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that stand earlier."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    left = bwt.removed(docs, "doc_id", "text")
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document; learned from rows that are not held out."""
    docs = table(spark, folder, "documents")
    model = language.train(docs.where(~held_out(F.col("doc_id"))), "doc_id", "text", "lang")
    found = language.predicted(docs.select("doc_id", "text"), "text", model)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "trusted"
    )


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that stand in a benchmark item."""
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    marked = automaton.hits(docs.select("doc_id", "text"), "text", items, "item_id", "text")
    return automaton.judged(marked.drop("text")).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join(F.sort_array("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op11_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Shingles and component of every document, and whether it is the one its component keeps."""
    found = chosenpath.near_copies(table(spark, folder, "documents"), "doc_id", "text")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


@query
def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The strongest collocations of every language."""
    docs = table(spark, folder, "documents").select("lang", "text")
    found = phrases.collocations(phrases.frequent(docs, "lang", "text"))
    listed = phrases.best(found, PHRASES).join(F.broadcast(phrases.totals(docs, "lang", "text")), "lang")
    return listed.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _tail_repeated(id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by the checksum of their id, repeat a stretch up to their end."""
    h = 1 if id is None else zlib.crc32(str(id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, the strongest one, and the text with each run cut to one period."""
    docs = table(spark, folder, "documents")
    found = periodic.collapsed(docs, "doc_id", "text", _tail_repeated)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    best = found.withColumn("best", periodic.strongest("runs"))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_CRC_STEP = "list_reduce(list_prepend(4294967295::UBIGINT, list_transform(flatten(list_transform(" \
    "regexp_extract_all(hex(encode(coalesce(text, ''))), '..')," \
    " lambda h: [('0x' || h)::UBIGINT, 0, 0, 0, 0, 0, 0, 0])), lambda v: v::UBIGINT))," \
    " lambda c, b: xor(xor(c, b) >> 1, 3988292384::UBIGINT * (xor(c, b) & 1)))"

ORACLES: dict[str, str] = {
    # The checksum bit by bit: every byte enters with the first of its eight steps.
    "op1_sharding": f"""
WITH sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size,
    xor({_CRC_STEP}, 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM documents
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto,
    sum(size) OVER () AS total
  FROM sized
), cut AS (
  SELECT *, ((2 * upto - size)::BIGINT * {SHARDS} // (2 * total::BIGINT))::INT AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot,
  NULL::INT AS grown_shard
FROM cut""",
    "op2_exact_dedup": r"""
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM hashed
  WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked""",
}

_SPACED = r"[^\x20\x09-\x0D]+"

ORACLES |= {
    "op5_mixing": rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_SPACED}')) AS size,
    md5('42:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), steps AS (
  SELECT *, 2 * source_size / weight AS ratio,
    (1.5::DOUBLE * sum(source_size) OVER ()
      - 2 * coalesce(sum(source_size) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY 2 * source_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), quota AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, weight * (
    SELECT s.level FROM steps s WHERE s.ratio > s.level ORDER BY s.ratio, s.source NULLS LAST LIMIT 1
  )) AS target FROM steps
), placed AS (
  SELECT d.*, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-9) ELSE 0 END AS full_times,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized d JOIN quota q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, source_size, target, (size * (full_times +
  CASE WHEN size > 0 AND 2 * upto - size <= 2 * round(target - full_times * source_size, 3)
  THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed""",
    "op10_decontamination": r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
    array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
  FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM windows), docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
), found AS (SELECT * FROM grams JOIN windows USING (n, gram)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
}

ORACLES |= {
    "op3_substrings": rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 12], ' ')) AS gram
  FROM docs, unnest(range(1, len(w) - 11)) AS t(i)
), firsts AS (SELECT gram, min(doc_id) AS first_id FROM windows GROUP BY gram),
hits AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS places
  FROM windows JOIN firsts USING (gram) WHERE first_id < doc_id GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(w) AS n_words, CASE WHEN places IS NULL THEN w ELSE
    list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
      lambda x: NOT list_contains(places, x[2])), lambda x: x[1]) END AS w
  FROM docs LEFT JOIN hits USING (doc_id)
)
SELECT doc_id, n_words, n_words - len(w) AS n_removed,
  sha256(array_to_string(w, ' ')) AS kept_sha256 FROM kept""",
}

ORACLES |= {
    "op12_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), listed AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM listed GROUP BY lang),
words AS (SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM listed),
followed AS (
  SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3
  FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)
), f AS (
  SELECT lang, 1 AS k, w1 AS g, count(*)::HUGEINT AS f, NULL AS head, NULL AS tail,
    NULL AS first_word, NULL AS last_word FROM followed GROUP BY lang, w1
  UNION ALL
  SELECT lang, 2, w1 || ' ' || w2, count(*), w1, w2, w1, w2 FROM followed
  WHERE w2 IS NOT NULL GROUP BY lang, w1, w2
  UNION ALL
  SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*), w1 || ' ' || w2, w2 || ' ' || w3, w1, w3
  FROM followed WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3
), candidates AS (SELECT *, f AS a FROM f WHERE f >= 10 AND k > 1),
sides AS (
  SELECT lang, g, a, 1 AS cut, first_word AS x, tail AS y FROM candidates
  UNION ALL SELECT lang, g, a, 2, head, last_word FROM candidates WHERE k = 3
), lowest AS (
  SELECT s.lang, s.g, a, x.f AS l, y.f AS r, 1000000 * a * a // (x.f * y.f) AS score
  FROM sides s JOIN f x ON x.lang = s.lang AND x.g = s.x JOIN f y ON y.lang = s.lang AND y.g = s.y
  QUALIFY row_number() OVER (PARTITION BY s.lang, s.g ORDER BY 1000000 * a * a // (x.f * y.f), cut) = 1
), held AS (
  SELECT lang, unnest([head, tail]) AS g, a FROM candidates WHERE k = 3
), dropped AS (
  SELECT DISTINCT c.lang, c.g FROM candidates c JOIN held h ON h.lang = c.lang AND h.g = c.g
  WHERE 100 * h.a >= 50 * c.a
), named AS (
  SELECT lang, g AS phrase, a, l, r, score FROM lowest ANTI JOIN dropped USING (lang, g)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM named JOIN totals USING (lang) QUALIFY rank <= 2000""",
}
