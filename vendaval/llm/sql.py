"""Checking SQL for the numbered operators that SQL can express."""

from __future__ import annotations

from vendaval.llm.importance import Draw
from vendaval.llm.lexical import Ranking
from vendaval.llm.words import PATTERN

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{PATTERN}')"


def importance_sql(draw: Draw = Draw()) -> str:
    """CRC-32 goes byte by byte in a recursive query over the different features."""
    both = [f"SELECT r, i, words[i] AS feature FROM {{0}} WHERE i <= n"]
    for length in range(2, draw.grams + 1):
        both.append(f"SELECT r, i, array_to_string(words[i : i + {length - 1}], ' ') FROM {{0}} WHERE i + {length - 1} <= n")
    features = " UNION ALL ".join(both)
    return f"""
WITH RECURSIVE docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS words FROM documents
), items AS MATERIALIZED (
    SELECT row_number() OVER () AS r, {_words("text")} AS words FROM benchmark
), doc_places AS (
    SELECT r, words, len(words) AS n, unnest(range(1, len(words) + 1)) AS i FROM docs
), item_places AS (
    SELECT r, words, len(words) AS n, unnest(range(1, len(words) + 1)) AS i FROM items
), doc_features AS MATERIALIZED ({features.format("doc_places")}
), item_features AS MATERIALIZED ({features.format("item_places")}
), step AS MATERIALIZED (
    SELECT byte::BIGINT AS byte, list_reduce([byte, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS value
    FROM (SELECT unnest(range(0, 256)) AS byte)
), different AS MATERIALIZED (
    SELECT feature, hex(encode(feature)) AS digits
    FROM (SELECT feature FROM doc_features UNION SELECT feature FROM item_features)
), crc (feature, digits, k, value) AS (
    SELECT feature, digits, 0, 4294967295 FROM different
    UNION ALL
    SELECT feature, digits, k + 1, xor(step.value, crc.value >> 8)
    FROM crc JOIN step
        ON step.byte = xor(crc.value & 255, ('0x' || substr(digits, 2 * k + 1, 2))::BIGINT)
    WHERE k < len(digits) // 2
), bucketed AS MATERIALIZED (
    SELECT feature, xor(value, 4294967295) % {draw.buckets} AS bucket FROM crc WHERE k = len(digits) // 2
), s AS (SELECT bucket, count(*) AS n FROM doc_features JOIN bucketed USING (feature) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS n FROM item_features JOIN bucketed USING (feature) GROUP BY bucket
), gains AS MATERIALIZED (
    SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE
            * ((SELECT count(*) FROM doc_features) + {draw.buckets})::DOUBLE
            / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM item_features) + {draw.buckets})::DOUBLE)))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket)
), sums AS (
    SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS total
    FROM doc_features JOIN bucketed USING (feature) JOIN gains USING (bucket) GROUP BY r
), weights AS (
    SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
        coalesce(floor(total::DOUBLE / n_features), 0)::BIGINT AS weight,
        ('0x' || substr(sha256('{draw.seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
    FROM docs LEFT JOIN sums USING (r)
), scores AS (
    SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weights
), places AS (
    SELECT *, row_number() OVER (ORDER BY n_words < {draw.least}, score DESC, doc_id NULLS LAST, n_features) AS place,
        count(*) FILTER (n_words >= {draw.least}) OVER () AS eligible
    FROM scores
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
    CASE WHEN place <= {draw.percent} * eligible // 100 THEN place END AS rank
FROM places
"""


def search_sql(ranking: Ranking = Ranking()) -> str:
    """Scores of all documents that hold a term of an item, and the best of them."""
    share = ranking.length_share
    return f"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS words FROM documents
), lengths AS MATERIALIZED (
    SELECT r, doc_id, len(words)::BIGINT AS n FROM docs WHERE len(words) > 0
), totals AS MATERIALIZED (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths
), counts AS MATERIALIZED (
    SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(words) AS term FROM docs) GROUP BY ALL
), items AS MATERIALIZED (
    SELECT row_number() OVER () AS item, item_id, {_words("text")} AS words
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
), asked AS MATERIALIZED (
    SELECT item, term, count(*)::BIGINT AS times FROM (SELECT item, unnest(words) AS term FROM items) GROUP BY ALL
), weights AS MATERIALIZED (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, totals GROUP BY term, docs
), impacts AS MATERIALIZED (
    SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * ({100 - share} + ({share} * n * docs) // terms))) AS impact
    FROM counts JOIN weights USING (term) JOIN lengths USING (r), totals
    WHERE term IN (SELECT term FROM asked)
), scores AS (
    SELECT item, r, sum(times * impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY item, r
), ranked AS (
    SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scores JOIN lengths USING (r) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN items USING (item) WHERE rank <= {ranking.k}
"""
