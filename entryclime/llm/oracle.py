"""DuckDB SQL for the queries of this folder that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_PART_LENGTH = "len(v) // 16"


def _assigned(books: str) -> str:
    """Every part with its nearest entry of ``books`` (part, entry, c): squared distance, ties to the lower entry."""
    return f"""
        SELECT p.vec_id, p.part, p.c AS c, min({{'d': list_sum(list_transform(list_zip(p.c, b.c),
                   lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'entry': b.entry}}) AS best
        FROM parts p JOIN {books} b ON p.part = b.part GROUP BY p.vec_id, p.part, p.c
    """


def _refined(before: str, assigned: str) -> str:
    """The codebooks after a round: floored means of the used entries (``//`` truncates, so the remainder is corrected)."""
    return f"""
        SELECT b.part, b.entry, CASE WHEN m.c IS NULL THEN b.c ELSE m.c END AS c
        FROM {before} b LEFT JOIN (
            SELECT part, entry, list(CAST(floor_mean AS BIGINT) ORDER BY position) AS c
            FROM (SELECT part, best.entry AS entry, position, count(*) AS n, sum(c[position]) AS total,
                         total // n - CASE WHEN total % n < 0 THEN 1 ELSE 0 END AS floor_mean
                  FROM {assigned}, (SELECT unnest(generate_series(1, (SELECT any_value(len(c)) FROM parts))) AS position)
                  GROUP BY part, best.entry, position)
            GROUP BY part, entry) m ON b.part = m.part AND b.entry = m.entry
    """


_VECTOR_CODES = f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
        SELECT vec_id, part, list_slice(v, part * ({_PART_LENGTH}) + 1, (part + 1) * ({_PART_LENGTH})) AS c
        FROM kept, (SELECT unnest(generate_series(0, 15)) AS part)),
    seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
              QUALIFY row_number() OVER (ORDER BY vec_id) <= 64),
    books0 AS MATERIALIZED (SELECT p.part, s.entry, p.c FROM parts p JOIN seeds s ON p.vec_id = s.vec_id),
    near0 AS MATERIALIZED ({_assigned("books0")}),
    books1 AS MATERIALIZED ({_refined("books0", "near0")}),
    near1 AS MATERIALIZED ({_assigned("books1")}),
    books2 AS MATERIALIZED ({_refined("books1", "near1")}),
    near2 AS MATERIALIZED ({_assigned("books2")}),
    coded AS (SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
                     CAST(sum(best.d) AS BIGINT) AS error FROM near2 GROUP BY vec_id)
    SELECT c.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM books2) AS codebooks_sha256
    FROM coded c JOIN kept k ON c.vec_id = k.vec_id
"""

_COLLOCATIONS = f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    numbered AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    spoken AS (SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM numbered),
    sizes AS (SELECT lang, count(*) AS n FROM spoken GROUP BY lang),
    rows AS (SELECT lang, w1, lead(w1, 1) OVER place AS w2, lead(w1, 2) OVER place AS w3
             FROM spoken WINDOW place AS (PARTITION BY id ORDER BY i)),
    grams AS (SELECT lang, 1 AS m, w1 AS phrase FROM rows
              UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM rows WHERE w2 IS NOT NULL
              UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM rows WHERE w3 IS NOT NULL),
    counts AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
    phrases AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1),
    parted AS (SELECT lang, m, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS l_part,
                      array_to_string(list_slice(w, k + 1, m), ' ') AS r_part
               FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM phrases)),
    cuts AS (SELECT p.lang, p.m, p.phrase, p.a, p.k, l.f AS l, r.f AS r,
                    1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f) AS score
             FROM parted p JOIN counts l ON l.lang = p.lang AND l.phrase = p.l_part
                           JOIN counts r ON r.lang = p.lang AND r.phrase = p.r_part),
    lowest AS (SELECT lang, m, phrase, a, min({{'score': score, 'k': k, 'l': l, 'r': r}}) AS cut
               FROM cuts GROUP BY ALL),
    longer AS (SELECT lang, array_to_string(list_slice(w, s, s + 1), ' ') AS phrase, max(a) AS most
               FROM (SELECT *, unnest([1, 2]) AS s FROM phrases WHERE m = 3) GROUP BY ALL),
    ranked AS (SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY cut.score DESC, a DESC, c.phrase) AS rank
               FROM lowest c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase
               WHERE most IS NULL OR 100 * most < 50 * a)
    SELECT r.lang, rank, phrase, a, cut.l AS l, cut.r AS r, n, CAST(cut.score AS BIGINT) AS score
    FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": f"""
        WITH hashed AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM hashed WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op6_warc": """
        WITH paid AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                             sha256(coalesce(html, '')) AS payload_digest FROM pages),
        first AS (SELECT *, CASE WHEN payload_bytes >= 100
                                 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS response
                  FROM paid)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> response THEN response END AS refers_to
        FROM first
    """,
    "op7_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        whole AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                   coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')
                       AS loss,
                   sum(length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 24) AS chars
            FROM turns GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
               CAST(chars AS BIGINT) AS formatted_chars
        FROM whole
    """,
    "op11_vector_codes": _VECTOR_CODES,
    "op13_collocations": _COLLOCATIONS,
}

#: All columns of op8_sharding but ``text_crc32``, which DuckDB has no function for; a test checks that one with zlib.
SHARDING_SQL = """
    WITH sized AS (
        SELECT doc_id, coalesce(strlen(text), 0) + 16 AS size,
               sum(coalesce(strlen(text), 0) + 16) OVER (ORDER BY doc_id) AS upto,
               sum(coalesce(strlen(text), 0) + 16) OVER () AS total
        FROM documents),
    placed AS (
        SELECT doc_id, size, CAST((2 * upto - size) * 40 // (2 * total) AS INTEGER) AS shard FROM sized)
    SELECT doc_id, CAST(size AS BIGINT) AS size, 'bytes' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM placed
"""
