"""The same results as ANSI SQL over the same tables, for checking with DuckDB."""

from __future__ import annotations

from claimstream.functions.hashing import PRIME, permutation
from claimstream.functions.text import ENTITY_PATTERN
from claimstream.operators.lsh import PERMUTATIONS, bands_for
from claimstream.plans.views import LANGUAGE_LABEL

BANDS, ROWS = bands_for()

# --- pieces -----------------------------------------------------------------------

SCORED = """
    scored AS (
        SELECT event_id AS id, ts, date_diff('day', DATE '1970-01-01', ts::DATE) AS batch_id,
               event_type AS key, event_type || ' ' || props AS claim,
               event_type AS entity_redacted_claim,
               CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS label,
               least(value / 100, 1.0) AS predicted_label
        FROM events
    ),
    judged AS (
        SELECT *, predicted_label >= 0.5 AS predicted_positive, label = '1' AS actual_positive,
               CASE WHEN predicted_label >= 0.5 AND label = '1' THEN 'true_positive'
                    WHEN predicted_label >= 0.5 THEN 'false_positive'
                    WHEN label = '0' THEN 'true_negative' ELSE 'false_negative' END
                   AS prediction_category
        FROM scored
    )"""

CONFUSION = """
    SELECT batch_id, count(*) AS batch_size,
           count(*) FILTER (prediction_category = 'true_positive') AS true_positives,
           count(*) FILTER (prediction_category = 'false_positive') AS false_positives,
           count(*) FILTER (prediction_category = 'true_negative') AS true_negatives,
           count(*) FILTER (prediction_category = 'false_negative') AS false_negatives
    FROM judged GROUP BY batch_id"""


def entities(text: str, pattern: str = ENTITY_PATTERN) -> str:
    return f"list_distinct(regexp_extract_all({text}, '{pattern}'))"


def redacted(text: str, found: str) -> str:
    ordered = (
        f"list_transform(list_sort(list_transform({found},"
        " lambda e: {'n': -length(e), 'e': e})), lambda s: s.e)"
    )
    held = f"list_reduce(list_prepend({text}, {ordered}), lambda t, e: replace(t, e, chr(57344)))"
    return f"replace({held}, chr(57344), '<ENTITY>')"


def tokens(text: str) -> str:
    kept = rf"regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}_\s<>]', '', 'g')"
    return rf"list_filter(regexp_split_to_array({kept}, '\s+'), lambda w: w <> '')"


def grams(table: str, id: str, text: str, extra: str = "", short: bool = False) -> str:
    """One row per word 3-gram; ``short`` texts give all their words as one."""
    last = "greatest(len(t) - 1, least(len(t), 1) + 1)" if short else "len(t) - 1"
    return f"""
    toks AS (SELECT {id} AS id {extra}, {tokens(text)} AS t FROM {table}),
    grams AS (
        SELECT * EXCLUDE (t), unnest(list_transform(range(1, {last}),
               lambda i: concat_ws(' ', t[i], t[i + 1], t[i + 2]))) AS pattern
        FROM toks
    )"""


def words(table: str, text: str) -> str:
    r"""Whitespace split that keeps empty words but for the trailing ones."""
    trimmed = rf"regexp_replace(lower({text}), '\s+$', '')"
    return rf"""
    words AS (
        SELECT id, unnest(regexp_split_to_array({trimmed}, '\s')) AS word FROM {table}
        WHERE NOT ({trimmed} = '' AND {text} <> '')
    )"""


DOCS = "docs AS (SELECT doc_id AS id, text AS claim, lang, source FROM documents)"

CLAIMS = f"""
    claims AS (
        SELECT doc_id AS id, text AS claim, {redacted('text', entities('text'))}
                   AS entity_redacted_claim, 1 - quality AS label
        FROM documents JOIN labels USING (doc_id)
    )"""


def minhash(table: str, scope: str = "") -> str:
    minima = []
    for i in range(PERMUTATIONS):
        a, b = permutation(i)
        minima.append(f"min((h * {a} + {b}) % {PRIME}) AS m{i}")
    hashed = "('0x' || substr(md5(pattern), 1, 7))::BIGINT AS h"
    extra = f", {scope}" if scope else ""
    return f"""
    {grams(table, 'id', 'claim', extra, short=True)},
    hashes AS (SELECT id {extra}, {hashed} FROM grams),
    signed AS (SELECT id {extra}, {', '.join(minima)} FROM hashes GROUP BY id {extra})"""


def linked(table: str, scope: str = "") -> str:
    extra = f"{scope}, " if scope else ""
    placed = " UNION ALL ".join(
        f"SELECT id, {extra}{band} AS band, concat_ws('-', "
        + ", ".join(f"m{band * ROWS + r}" for r in range(ROWS))
        + ") AS bucket FROM signed"
        for band in range(BANDS)
    )
    return f"""
    {minhash(table, scope)},
    placed AS ({placed}),
    buckets AS (
        SELECT *, min(id) OVER b AS first_id, count(*) OVER b AS n FROM placed
        WINDOW b AS (PARTITION BY {extra}band, bucket)
    ),
    links AS (SELECT {extra}band, first_id, id FROM buckets WHERE n > 1)"""


CLUSTERS = """
    SELECT cluster_id, id FROM (SELECT id, min(first_id) AS cluster_id FROM links
                                WHERE first_id < id GROUP BY id)"""


def estimate(key: str) -> str:
    """DGIM estimates by following resets of the overhang, see claimstream.operators.dgim."""
    return f"""
    {SCORED},
    bits AS (
        SELECT {key} AS key, id, batch_id, ts,
               CASE WHEN predicted_label >= 0.5 THEN 1 ELSE 0 END AS bit FROM scored
    ),
    placed AS (
        SELECT key, id, batch_id, bit, row_number() OVER w AS pos,
               (sum(bit) OVER (PARTITION BY key ORDER BY ts, id
                   ROWS BETWEEN 999 PRECEDING AND CURRENT ROW))::BIGINT AS exact,
               (sum(bit) OVER (PARTITION BY key ORDER BY ts, id
                   ROWS BETWEEN 1000 PRECEDING AND 1 PRECEDING))::BIGINT AS held,
               lag(bit, 1000, 0) OVER w AS leaves
        FROM bits WINDOW w AS (PARTITION BY key ORDER BY ts, id)
    ),
    counted AS (
        SELECT *, (sum(leaves) OVER (PARTITION BY key ORDER BY pos))::BIGINT AS gone FROM placed
    ),
    leaving AS (SELECT key, gone AS j, held FROM counted WHERE leaves = 1),
    sizes AS (SELECT 1::BIGINT << m AS s FROM range(0, 10) t(m)),
    starts AS (SELECT key, j FROM leaving UNION SELECT DISTINCT key, 0::BIGINT FROM bits),
    hops AS (
        SELECT a.key, a.j, min(l.j) AS next
        FROM starts a CROSS JOIN sizes JOIN leaving l ON l.key = a.key AND l.j = a.j + s
        WHERE l.held >= s AND l.held < 3 * s GROUP BY a.key, a.j
    ),
    resets AS (
        SELECT DISTINCT key, 0::BIGINT AS j FROM bits
        UNION ALL
        SELECT hops.key, hops.next FROM resets JOIN hops USING (key, j)
    ),
    estimates AS (
        SELECT c.key, c.id, c.batch_id, c.bit, c.pos, c.exact, c.exact + c.gone - r.j AS estimate
        FROM counted c ASOF JOIN resets r ON c.key = r.key AND c.gone >= r.j
    )"""


def merged(buckets: str, size: int) -> str:
    """Of three buckets of one size, newest first, the two older ones become one."""
    same = f"list_filter({buckets}, lambda x: x.size = {size})"
    return f"""CASE WHEN len({same}) = 3 THEN list_concat(
        list_filter({buckets}, lambda x: x.size < {size}), {same}[1:1],
        [{{'size': {2 * size}, 'ts': {same}[2].ts}}],
        list_filter({buckets}, lambda x: x.size > {size})) ELSE {buckets} END"""


# The histogram itself, bit by bit: expire, add, merge; an estimate counts every bucket in full.
BIT_BY_BIT = f"""
    {SCORED},
    bits AS (
        SELECT row_number() OVER (ORDER BY ts, id) AS pos,
               CASE WHEN predicted_label >= 0.5 THEN 1 ELSE 0 END AS bit FROM scored
    ),
    walk AS (
        SELECT 0::BIGINT AS pos, []::STRUCT(size INTEGER, ts BIGINT)[] AS b
        UNION ALL
        SELECT pos, {merged('b', 16)} AS b FROM (
            SELECT pos, {merged('b', 8)} AS b FROM (
                SELECT pos, {merged('b', 4)} AS b FROM (
                    SELECT pos, {merged('b', 2)} AS b FROM (
                        SELECT pos, {merged('b', 1)} AS b FROM (
                            SELECT bits.pos, CASE WHEN bit = 1 THEN list_prepend(
                                {{'size': 1, 'ts': bits.pos}},
                                list_filter(walk.b, lambda x: x.ts > bits.pos - 16))
                                ELSE list_filter(walk.b, lambda x: x.ts > bits.pos - 16) END AS b
                            FROM walk JOIN bits ON bits.pos = walk.pos + 1)))))
    )"""

SAMPLE = """
    sampled AS (
        SELECT id, md5('42:' || id) AS priority, prediction_category FROM judged
        ORDER BY priority, id LIMIT 100
    )"""

LABEL = (
    "CASE lang "
    + " ".join(f"WHEN '{lang}' THEN '{name}'" for lang, name in LANGUAGE_LABEL.items())
    + " END"
)

WORD = "[\\p{L}\\p{N}]+"

DICTIONARY = f"""
    names AS (
        SELECT DISTINCT regexp_extract_all(entity, '{WORD}') AS name
        FROM (SELECT unnest({entities('text')}) AS entity FROM benchmark)
    ),
    parts AS (
        SELECT doc_id AS id, regexp_extract_all(text, '{WORD}') AS w,
               regexp_split_to_array(text, '{WORD}') AS gaps FROM documents
    ),
    runs AS (
        SELECT id, w, gaps, i, n FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM parts),
               (SELECT DISTINCT len(name) AS n FROM names)
        WHERE i + n - 1 <= len(w)
    ),
    found AS (
        SELECT id, list(DISTINCT array_to_string(list_transform(range(i, i + n),
                   lambda k: CASE WHEN k = i THEN w[k] ELSE gaps[k] || w[k] END), '')) AS e
        FROM runs JOIN names ON name = w[i : i + n - 1] GROUP BY id
    )"""

# The text a message is read by: every third document has a redacted one.
CHOSEN = f"""coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN {redacted('text', entities('text'))}
                                  ELSE '' END, ''), text)"""

POSITIVE_DOCS = f"""
    docs AS (
        SELECT doc_id AS id, {CHOSEN} AS claim, source FROM documents LEFT JOIN labels USING (doc_id)
        WHERE quality IS DISTINCT FROM 1
    )"""

# Half of the documents by the parity of the crc32 of the id, computed bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(flatten(list_transform(
    regexp_extract_all(hex(encode(id::VARCHAR)), '..'), lambda h: [('0x' || h)::UBIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda v: v::UBIGINT)), lambda c, b: xor(xor(c, b) >> 1, 3988292384::UBIGINT * (xor(c, b) & 1))),
    4294967295::UBIGINT)"""

RANKS = "SELECT unnest(range(1, 31)) AS rank"

# --- the queries ------------------------------------------------------------------

ORACLES: dict[str, str] = {
    "read_claims": f"WITH {CLAIMS} SELECT claim, entity_redacted_claim, label FROM claims",
    "claims_prepare": f"""
        WITH lines AS (SELECT text AS claim, {LABEL} AS label FROM documents)
        SELECT claim, {redacted('claim', entities('claim'))} AS entity_redacted_claim,
               CASE label WHEN 'SUPPORTS' THEN 0 ELSE 1 END AS label
        FROM lines WHERE label IN ('SUPPORTS', 'REFUTES', 'NOT ENOUGH INFO')""",
    "claims_redact": f"""
        SELECT doc_id AS id, len({entities('text')}) AS n_entities,
               {redacted('text', entities('text'))} AS redacted FROM documents""",
    "dictionary_redact": f"""
        WITH {DICTIONARY}
        SELECT doc_id AS id, {redacted('text', "coalesce(e, []::VARCHAR[])")} AS redacted
        FROM documents LEFT JOIN found ON found.id = doc_id""",
    "claim_text": f"SELECT doc_id AS id, {CHOSEN} AS text FROM documents",
    "corpus_rejects": """
        SELECT '{broken ' || doc_id AS line FROM documents WHERE doc_id % 100 = 0""",
    "shingle_counts": f"""
        SELECT doc_id AS id, len({tokens('text')}) AS n_tokens,
               greatest(len({tokens('text')}) - 2, 0) AS n_shingles FROM documents""",
    "publish_keyed": """
        SELECT 'fever' AS key, text AS claim, 1 - quality AS label
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "payload_roundtrip": f"""
        WITH {SCORED} SELECT id, batch_id, key, claim, entity_redacted_claim, label,
                             predicted_label FROM scored""",
    "positive_bits": f"""
        WITH {SCORED} SELECT id, CASE WHEN predicted_positive THEN 1 ELSE 0 END AS is_positive
        FROM judged""",
    "prediction_category": f"""
        WITH {SCORED} SELECT id, predicted_positive, actual_positive, prediction_category
        FROM judged""",
    "batch_counts": f"""
        WITH {SCORED} SELECT batch_id, count(*) AS row_count,
                             count(*) FILTER (predicted_positive) AS positive_count
        FROM judged GROUP BY batch_id""",
    "confusion_by_batch": f"WITH {SCORED} {CONFUSION}",
    "quality_metrics": f"""
        WITH {SCORED}, c AS ({CONFUSION}),
        r AS (
            SELECT *, (true_positives + true_negatives) / batch_size AS accuracy,
                   coalesce(true_positives / nullif(true_positives + false_positives, 0), 0)
                       AS precision,
                   coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0)
                       AS recall
            FROM c
        )
        SELECT *, CASE WHEN precision + recall > 0
                       THEN 2 * (precision * recall) / (precision + recall)
                       ELSE 0.0 END AS f1_score FROM r""",
    "head_sample": f"""
        WITH {SCORED} SELECT batch_id, row_number() OVER (PARTITION BY batch_id ORDER BY ts, id)
                             AS arrival, id, predicted_label
        FROM scored QUALIFY arrival <= 5""",
    "state_latest": f"""
        WITH {SCORED}, snapshots AS (
            SELECT key, batch_id, count(*) AS row_count,
                   count(*) FILTER (predicted_positive) AS positive_count
            FROM judged GROUP BY key, batch_id)
        SELECT * FROM snapshots
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY batch_id DESC) = 1""",
    "ngram_topk": f"""
        WITH {DOCS}, {grams('docs', 'id', 'claim')}
        SELECT pattern, count(*) AS count FROM grams GROUP BY pattern
        ORDER BY count DESC, pattern LIMIT 50""",
    "pattern_record": f"""
        WITH {DOCS}, {grams('docs', 'id', 'claim', ', source')},
        counts AS (SELECT source, pattern, count(*) AS count FROM grams GROUP BY ALL),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY count DESC, pattern) AS rank
            FROM counts QUALIFY rank <= 50)
        SELECT source, to_json(list({{'pattern': pattern, 'count': count}} ORDER BY rank))::VARCHAR
               AS patterns FROM ranked GROUP BY source""",
    "vocabulary": f"""
        WITH {DOCS}, {words('docs', 'claim')}
        SELECT word, count(*) AS uses FROM words GROUP BY word""",
    "tfidf_terms": f"""
        WITH {DOCS}, {words('docs', 'claim')}
        SELECT word, count(DISTINCT id) AS doc_freq,
               round(ln(((SELECT count(*) FROM docs) + 1) / (count(DISTINCT id) + 1)), 6) AS idf
        FROM words GROUP BY word""",
    "reservoir_sample": f"WITH {SCORED}, {SAMPLE} SELECT * FROM sampled",
    "reservoir_distribution": f"""
        WITH {SCORED}, {SAMPLE},
        names AS (SELECT unnest(['true_positive', 'false_positive', 'true_negative',
                                 'false_negative']) AS prediction_category),
        n AS (SELECT prediction_category, count(id) AS sample_count
              FROM names LEFT JOIN sampled USING (prediction_category) GROUP BY ALL)
        SELECT *, sample_count * 100.0::DOUBLE / (SELECT count(*) FROM sampled) AS percent FROM n""",
    "split": f"""
        SELECT doc_id AS id,
               ('0x' || substr(md5('42:' || doc_id), 1, 7))::BIGINT < {int(0.8 * 16**7)} AS is_train
        FROM documents""",
    "minhash_signatures": f"""
        WITH {DOCS}, {minhash('docs')}
        SELECT id, concat_ws(',', {', '.join(f'm{i}' for i in range(PERMUTATIONS))}) AS signature
        FROM signed""",
    "lsh_links": f"WITH {DOCS}, {linked('docs')} SELECT * FROM links",
    "lsh_verified_links": f"""
        WITH {DOCS}, {grams('docs', 'id', 'claim', short=True)},
        sets AS (SELECT DISTINCT id, pattern FROM grams),
        sizes AS (SELECT id, count(*) AS n FROM sets GROUP BY id),
        shared AS (
            SELECT l.id AS similar_id, r.id AS id, count(*) AS common
            FROM sets l JOIN sets r ON l.pattern = r.pattern AND l.id < r.id GROUP BY ALL)
        SELECT s.id, min(similar_id) AS similar_id
        FROM shared s JOIN sizes a ON a.id = s.similar_id JOIN sizes b ON b.id = s.id
        WHERE 10 * common >= 7 * (a.n + b.n - common) GROUP BY s.id""",
    "similar_claims": f"""
        WITH {DOCS}, {linked('docs')}
        SELECT DISTINCT l.id, l.first_id AS similar_id, s.claim AS similar_text,
               d.claim AS claim_text
        FROM links l JOIN docs s ON s.id = l.first_id JOIN docs d ON d.id = l.id
        WHERE l.id > l.first_id""",
    "similarity_clusters": f"WITH {DOCS}, {linked('docs')} {CLUSTERS}",
    "lsh_summary": f"""
        WITH {POSITIVE_DOCS}, {linked('docs', 'source')}
        SELECT source, count(*) AS row_count,
               count(*) FILTER (quality IS DISTINCT FROM 1) AS positive_count,
               count(*) FILTER (doc_id IN (SELECT id FROM links WHERE id > first_id))
                   AS similar_count
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
    "stream_positions": f"""
        WITH {SCORED} SELECT key, id, row_number() OVER (PARTITION BY key ORDER BY ts, id) AS pos
        FROM scored""",
    "window_exact": f"""
        WITH {SCORED} SELECT key, id, row_number() OVER (PARTITION BY key ORDER BY ts, id) AS pos,
               count(*) FILTER (predicted_positive) OVER (PARTITION BY key ORDER BY ts, id
                   ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS exact
        FROM judged""",
    "dgim_estimate": f"""
        WITH RECURSIVE {estimate('key')}
        SELECT key, id, pos, exact, estimate FROM estimates""",
    "dgim_small_window": f"""
        WITH RECURSIVE {BIT_BY_BIT}
        SELECT pos, (sum(bit) OVER (ORDER BY pos ROWS BETWEEN 15 PRECEDING AND CURRENT ROW))::BIGINT
                   AS exact, coalesce(list_sum(list_transform(b, lambda x: x.size)), 0)::BIGINT
                   AS estimate
        FROM walk JOIN bits USING (pos)""",
    "dgim_bounds": f"""
        WITH {SCORED} SELECT row_number() OVER (ORDER BY ts, id) AS pos,
               count(*) FILTER (predicted_positive) OVER (ORDER BY ts, id
                   ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS exact, TRUE AS within
        FROM judged""",
    "dgim_batch_stats": f"""
        WITH RECURSIVE {estimate("'all'")},
        daily AS (
            SELECT key, batch_id, max(pos) AS stream_position,
                   max_by(estimate, pos) AS approximate_count,
                   max_by(exact, pos) AS exact_window_count,
                   sum(bit)::BIGINT AS actual_count, count(*) AS batch_size, 1000 AS window_size
            FROM estimates GROUP BY key, batch_id)
        SELECT *, approximate_count / 1000 AS positive_ratio,
               CASE WHEN actual_count > 0
                    THEN abs(approximate_count - actual_count) / actual_count * 100
                    ELSE 0.0 END AS error_percentage
        FROM daily""",
    "stream_confusion": f"""
        WITH {SCORED}, c AS ({CONFUSION})
        SELECT sum(batch_size)::BIGINT AS total_processed, sum(batch_size)::BIGINT AS batch_size,
               sum(true_positives)::BIGINT AS true_positives,
               sum(false_positives)::BIGINT AS false_positives,
               sum(true_negatives)::BIGINT AS true_negatives,
               sum(false_negatives)::BIGINT AS false_negatives FROM c""",
    "stream_batches": f"""
        WITH {SCORED}, c AS ({CONFUSION}),
        sliced AS (SELECT *, (batch_id - (SELECT min(batch_id) FROM c)) // 8 AS slice FROM c),
        sums AS (
            SELECT slice AS batch_id, sum(batch_size)::BIGINT AS batch_size,
                   sum(true_positives)::BIGINT AS true_positives,
                   sum(false_positives)::BIGINT AS false_positives,
                   sum(true_negatives)::BIGINT AS true_negatives,
                   sum(false_negatives)::BIGINT AS false_negatives FROM sliced GROUP BY slice)
        SELECT *, (sum(batch_size) OVER (ORDER BY batch_id))::BIGINT AS total_processed FROM sums""",
    "stream_reservoir": f"WITH {SCORED}, {SAMPLE} SELECT * FROM sampled",
    "stream_dgim": f"""
        WITH RECURSIVE {estimate('key')}
        SELECT key, max(pos) AS pos, max_by(estimate, pos) AS estimate FROM estimates GROUP BY key""",
    "stream_dgim_state": f"""
        WITH RECURSIVE {estimate('key')}
        SELECT key, max(pos) AS pos, max_by(exact, pos) AS exact, max_by(estimate, pos) AS estimate
        FROM estimates GROUP BY key""",
    "window_state_read": f"""
        WITH RECURSIVE {estimate('key')}
        SELECT key, max(pos) AS pos, max_by(estimate, pos) AS estimate FROM estimates GROUP BY key""",
    "stream_lsh_index": f"WITH {DOCS}, {linked('docs')} SELECT * FROM links",
    "stream_lsh": f"""
        WITH all_{POSITIVE_DOCS.strip()},
        docs AS (SELECT id, claim, {CRC32} % 2 AS half FROM all_docs),
        {linked('docs', 'half')} {CLUSTERS}""",
    "stream_score": """
        SELECT (1 - quality)::VARCHAR AS label, TRUE AS decided, count(*) AS n
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality
        UNION ALL
        SELECT 'rejected', FALSE, count(*) FROM documents WHERE doc_id % 100 = 0""",
    "train_eval": f"""
        WITH rows AS (
            SELECT ('0x' || substr(md5('42:' || doc_id), 1, 7))::BIGINT < {int(0.8 * 16**7)} AS t
            FROM documents JOIN labels USING (doc_id))
        SELECT count(*) FILTER (t) AS train_rows, count(*) FILTER (NOT t) AS test_rows,
               TRUE AS at_least_guessing FROM rows""",
    "score_claims": """
        SELECT doc_id AS id, 1 - quality AS label, TRUE AS decided
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "feature_importance": f"SELECT rank, TRUE AS agrees FROM ({RANKS})",
    "feature_words": f"SELECT rank, TRUE AS words_belong FROM ({RANKS})",
    "importance_report": "SELECT TRUE AS has_rows, 0 AS wrong",
    "dgim_buckets": f"""
        WITH RECURSIVE {estimate('key')},
        ends AS (
            SELECT key, max(pos) AS stream_position, max_by(estimate, pos) AS total_ones
            FROM estimates GROUP BY key),
        levels AS (
            SELECT *, floor(log2(total_ones + 1))::INT AS levels FROM ends WHERE total_ones > 0),
        digits AS (
            SELECT *, m, 1 + ((total_ones - ((1 << levels) - 1)) >> m & 1) AS n
            FROM levels, range(0, 40) t(m) WHERE m < levels),
        buckets AS (
            SELECT *, (1::BIGINT << m) AS size,
                   coalesce(sum(1::BIGINT << m) OVER (PARTITION BY key ORDER BY m, copy
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS newer
            FROM digits, range(0, 2) c(copy) WHERE copy < n),
        ones AS (
            SELECT key, pos AS ts, row_number() OVER (PARTITION BY key ORDER BY pos DESC) - 1 AS newer
            FROM estimates WHERE bit = 1)
        SELECT key, 1000 AS window_size, stream_position, total_ones, size, ts
        FROM buckets JOIN ones USING (key, newer)""",
    "stream_table": f"""
        WITH {SCORED} SELECT id, batch_id AS day, claim, label, predicted_label FROM scored""",
    "stream_dedup": f"WITH {SCORED} SELECT id, key, batch_id FROM scored",
}
