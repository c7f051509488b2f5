"""The catalogue's queries as SQL for DuckDB, each written from the definition of its result."""

from __future__ import annotations


def norm(text: str) -> str:
    for pattern in (r"\[.*?\]", r"\(.*?\)", r"\{.*?\}", "<.*?>"):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    text = rf"regexp_replace({text}, '[^\p{{L}}\p{{N}}\s]', ' ', 'g')"
    return rf"trim(regexp_replace(strip_accents({text}), '\s+', ' ', 'g'))"


def word_list(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda w: w <> '')"


UTTERANCES = """utterances AS (
    SELECT doc_id::VARCHAR AS utt_id, text, n_chars / 100.0::DOUBLE AS duration, source AS "OG_corpus", lang
    FROM documents)"""

# The places that Python's sampler, seeded with 42, draws for 9 of 200 rows.
SAMPLED_OF_200 = (6, 28, 35, 57, 62, 70, 163, 188, 189)

SPLIT = """CASE WHEN row_number() OVER (PARTITION BY "OG_corpus" ORDER BY md5('42:' || utt_id), utt_id)
    <= greatest(1, floor(count(*) OVER (PARTITION BY "OG_corpus") * 0.048::DOUBLE)) THEN 'test' ELSE 'train' END"""

LABELLED = f"""{UTTERANCES}, labelled AS (SELECT *, {SPLIT} AS split FROM utterances)"""

TURN_PAIRS = f"""pairs AS (
    SELECT u.conv_id, u.turn, {norm("u.text")} AS ref, {norm("a.text")} AS hyp
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant')"""

# Word edit distance by anti-diagonals of the table: each needs the two before it only.
TURN_EDITS = f"""{TURN_PAIRS}, lists AS (
    SELECT conv_id, turn, {word_list("ref")} AS a, {word_list("hyp")} AS b FROM pairs
), coded AS (
    SELECT conv_id, turn, list_transform(a, lambda w: list_position(v, w)) AS a,
        list_transform(b, lambda w: list_position(v, w)) AS b, len(a) AS n, len(b) AS m
    FROM (SELECT *, list_distinct(list_concat(a, b)) AS v FROM lists)
), diagonal(conv_id, turn, a, b, n, m, k, cur, prev) USING KEY (conv_id, turn) AS (
    SELECT conv_id, turn, a, b, n, m, 0::BIGINT, list_transform(range(n + 1), lambda i: 0::BIGINT),
        list_transform(range(n + 1), lambda i: 0::BIGINT)
    FROM coded
    UNION
    SELECT conv_id, turn, a, b, n, m, k + 1, list_transform(range(n + 1), lambda i:
        CASE WHEN k + 1 - i < 0 OR k + 1 - i > m THEN NULL WHEN i = 0 OR i = k + 1 THEN k + 1
        ELSE least(cur[i] + 1, cur[i + 1] + 1, prev[i] + (a[i] <> b[k + 1 - i])::INT) END), cur
    FROM diagonal WHERE k < n + m
), edits AS (SELECT conv_id, turn, cur[n + 1] AS edits, n AS ref_words FROM diagonal)"""

# The made-up hypothesis loses every 7th word and swaps every other 11th for a word that no
# text has. Each costs one edit and none can cost less, so the distance is their number.
MISHEARD_EDITS = "n // 7 + n // 11 - n // 77"

LABEL_ROWS = f"""rows AS (
    SELECT conv_id, conv_id || '-' || turn AS key, list_concat(
        CASE WHEN conv_id % 4 = 0 THEN []::BIGINT[] ELSE [1::BIGINT] END,
        list_transform({word_list(norm("text"))}, lambda w: length(w))) AS labels
    FROM conversations)"""

AUDIO = """stored AS (
    SELECT *, 'corpus/' || source || CASE WHEN lang = 'en' THEN '/test/' ELSE '/part/' END || doc_id || '.wav' AS path,
        CASE doc_id % 10 WHEN 7 THEN 'transcript not found' WHEN 5 THEN 'transcript is not UTF-8'
            WHEN 3 THEN 'audio header not readable' END AS reason
    FROM documents)"""

ADDRESS = r"regexp_replace(url, '[?#].*', '')"
# the same with hidden names and empty recordings
FILES = """files AS (SELECT regexp_replace(path, '[^/]*$', '') || CASE WHEN doc_id % 17 = 0 THEN '_'
    WHEN doc_id % 19 = 0 THEN '.' ELSE '' END || regexp_extract(path, '[^/]*$') AS path,
    CASE WHEN doc_id % 23 = 0 THEN coalesce(reason, 'audio header not readable') ELSE reason END AS reason FROM stored)"""


def through_buffer(key: str, seed: int, size: int = 8) -> str:
    """Rows ``reader, i`` of the table ``s`` in the order in which a buffer of ``size`` rows lets them go."""
    digits = f"('0x' || substr(md5('{seed}:' || reader || ':' || i), 1, 8))::BIGINT"
    return f"""t AS (SELECT *, CASE WHEN i < {size} THEN i ELSE {digits} % {size} END AS slot, count(*) OVER (PARTITION BY reader) AS n FROM s),
        through_buffer AS (SELECT {key}, reader, coalesce(
        lead(i) OVER (PARTITION BY reader, slot ORDER BY i) - least(n, {size}), n - 1 - slot)::BIGINT AS place FROM t)"""


ORACLE: dict[str, str] = {
    "normalize_documents": f"SELECT doc_id, {norm('text')} AS text FROM documents",
    "normalize_lowercase": f"SELECT doc_id, {norm('lower(text)')} AS text FROM documents",
    "normalize_conversations": f"SELECT conv_id, turn, {norm('text')} AS text FROM conversations",
    "normalize_pages": f"SELECT page_id, {norm('html')} AS text FROM pages",
    "normalize_benchmark": f"SELECT item_id, {norm('text')} AS text FROM benchmark",
    "normalize_turn_lists": f"""SELECT conv_id, turn, len(string_split(text, chr(10))) AS n_lines,
        array_to_string(list_transform(string_split(text, chr(10)), lambda t: {norm("t")}), '|') AS lines
        FROM conversations""",
    "strip_path_keys": f"""WITH p AS (SELECT page_id, {ADDRESS} AS a FROM pages)
        SELECT page_id, a || '.wav' AS path, CASE WHEN suffix(a, '/') THEN a || '.wav' ELSE a END AS stem,
        string_split(a, '/')[-2] AS parent,
        CASE WHEN contains(lower(a), 'test') THEN 'test' ELSE 'train' END AS split,
        a || '.mp3' AS ref_path, a AS utt_id FROM p""",
    "duration_band": f"""WITH {UTTERANCES} SELECT utt_id, duration FROM utterances
        WHERE duration BETWEEN 0.5 AND 30.0""",
    "vote_filter": "SELECT doc_id, quality, toxic FROM labels WHERE quality >= 1",
    "bad_rows": """SELECT CASE WHEN l.doc_id IS NULL THEN 'no audio' WHEN quality IS DISTINCT FROM 1 THEN
        'no audio bytes' WHEN n_chars IS NULL THEN 'no duration' WHEN text IS NULL THEN 'no text'
        ELSE 'usable' END AS reason, count(*) AS n_rows
        FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""",
    "relabel_corpus": """SELECT page_id, CASE WHEN contains(url, '/fr/') THEN 'french_web' ELSE 'web' END
        AS "OG_corpus" FROM pages""",
    "conform_schema": f"""WITH {UTTERANCES} SELECT NULL::VARCHAR AS path, text, duration, NULL::VARCHAR AS split,
        "OG_corpus", utt_id, lang, 'None' AS task, 'None' AS translation_en, 'None' AS original_audio_id,
        0.0::DOUBLE AS original_audio_offset FROM utterances""",
    "map_row_function": "SELECT doc_id, lang || '-' || source AS label FROM documents WHERE n_chars % 2 = 0",
    "assign_split_exact": f"""WITH {LABELLED} SELECT utt_id, "OG_corpus", split FROM labelled""",
    "assign_split_whole_table": """SELECT o_orderkey, CASE WHEN row_number() OVER (
        ORDER BY md5('42:' || o_orderkey), o_orderkey) <= greatest(1, floor(count(*) OVER () * 0.048::DOUBLE))
        THEN 'test' ELSE 'train' END AS split FROM orders""",
    "split_report": f"""WITH {LABELLED}, r AS (SELECT "OG_corpus", duration,
        CASE lang WHEN 'es' THEN NULL WHEN 'de' THEN 'validation' ELSE split END AS split FROM labelled)
        SELECT "OG_corpus", split, coalesce(split NOT IN ('train', 'test'), true) AS dropped, count(*) AS n_utterances,
        round(sum(duration), 2) AS total_seconds FROM r GROUP BY ALL""",
    "assign_split_by_position": f"""WITH p AS (
        SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents)
        SELECT doc_id, n // 200 AS shard, n % 200 AS idx,
        CASE WHEN n % 200 IN {SAMPLED_OF_200} THEN 'test' ELSE 'train' END AS split FROM p""",
    "sharded_again": """SELECT doc_id::VARCHAR AS utt_id, 'YODAS' AS name,
        (row_number() OVER (ORDER BY doc_id) - 1) // 500 AS shard FROM documents""",
    "label_splits_repeated_key": """WITH s AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS shard FROM documents)
        SELECT shard, count(*) AS n_rows, greatest(1, floor(count(*) * 0.048::DOUBLE))::BIGINT AS n_test FROM s GROUP BY 1""",
    "prepare_corpus": f"""WITH {LABELLED}, kept AS (SELECT "OG_corpus", split, duration, {norm("text")} AS text
        FROM labelled WHERE duration <= 30.0 AND (split <> 'train' OR duration >= 0.5))
        SELECT "OG_corpus", split, count(*) AS n_utterances, round(sum(duration), 2) AS total_seconds,
        sum(length(text)) AS n_letters, sum(len({word_list("text")})) AS n_words FROM kept GROUP BY ALL""",
    "write_and_read_splits": f"""WITH {LABELLED} SELECT utt_id, {norm("text")} AS text, duration, "OG_corpus", split
        FROM labelled WHERE duration <= 30.0""",
    "create_dataset": f"""WITH {UTTERANCES}, placed AS (SELECT *, (row_number() OVER (ORDER BY utt_id::BIGINT) - 1) // 200
        AS shard FROM utterances), labelled AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY shard
        ORDER BY md5('42:' || utt_id), utt_id) <= greatest(1, floor(count(*) OVER (PARTITION BY shard) * 0.048::DOUBLE))
        THEN 'test' ELSE 'train' END AS split FROM placed)
        SELECT utt_id, 'yodas_granary' AS "OG_corpus", duration, split FROM labelled WHERE duration <= 30.0""",
    "total_rows": "SELECT count(*) AS n_rows FROM lineitem",
    "shard_contiguous": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS shard FROM documents",
    "shard_by_key": """SELECT url, page_id, (row_number() OVER (ORDER BY url, page_id) - 1) // 100 AS shard
        FROM pages""",
    "shard_counts": """SELECT shard, count(*) AS n_rows FROM (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1)
        // 20000 AS shard FROM orders) GROUP BY 1""",
    "row_index_in_shard": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 200 AS idx FROM documents",
    "write_and_read_shards": f"""SELECT conv_id, turn, {norm("text")} AS text,
        (row_number() OVER (ORDER BY conv_id, turn) - 1) // 100 AS shard FROM conversations""",
    "union_drifting_files": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "replaced_shards": f"""SELECT conv_id, turn, shard, trim(CASE WHEN shard % 3 = 0 THEN {norm("text")} ELSE text END) AS text
        FROM (SELECT *, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 100 AS shard FROM conversations)""",
    "reader_assignment": """WITH s AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS shard FROM documents)
        SELECT shard % 3 AS reader, count(*) AS n_rows, count(DISTINCT shard) AS n_shards FROM s GROUP BY 1""",
    "union_relaxed": """SELECT doc_id, source, n_chars::DOUBLE AS size FROM documents
        UNION ALL SELECT doc_id, source, n_chars / 100.0::DOUBLE FROM documents""",
    "head_rows": "SELECT text FROM documents ORDER BY doc_id LIMIT 5",
    "arrow_ipc_roundtrip": "SELECT doc_id, lang, text FROM documents",
    "csv_in_blocks": """
SELECT doc_id::BIGINT AS doc_id, md5(t) AS digest, length(t)::BIGINT AS n_chars
FROM (SELECT doc_id, 'He said "' || replace(text, '. ', '."' || chr(10) || chr(10) || '",') AS t FROM documents)""",
    "arrow_filtered": """SELECT o_orderkey::BIGINT AS o_orderkey, o_orderstatus FROM orders
        WHERE o_orderkey BETWEEN 500 AND 9000 AND o_orderstatus IN ('F', 'P') AND o_totalprice > 1000""",
    "arrow_head_rows": "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 30",
    "reference_last_wins": """SELECT 'c' || conv_id || '.mp3' AS path, arg_max(text, turn) AS sentence
        FROM conversations GROUP BY conv_id""",
    "reference_lookup": """SELECT 'doc_' || doc_id || '.wav' AS name, 'doc_' || doc_id || '.mp3' AS path,
        'doc_' || doc_id AS utt_id, text AS sentence FROM documents JOIN labels USING (doc_id) WHERE quality >= 1""",
    "missing_audio_rejects": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "present_audio": "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "references_from_csv": """SELECT 'doc_' || doc_id || '.mp3' AS path, text AS sentence, quality AS up_votes
        FROM documents JOIN labels USING (doc_id)""",
    "script_names": "SELECT 'clip_' || doc_id || '.wav' AS name FROM documents WHERE doc_id % 3 <> 0",
    "trn_lines": f"SELECT {norm('text')} || ' (' || doc_id || ')' AS line FROM documents",
    "write_and_read_transcripts": f"""WITH {TURN_PAIRS} SELECT side, line FROM (
        SELECT 'hyp' AS side, hyp || ' (' || conv_id || '-' || turn || ')' AS line FROM pairs
        UNION ALL SELECT 'ref', ref || ' (' || conv_id || '-' || turn || ')' FROM pairs)""",
    "wer_by_source": f"""WITH c AS (SELECT source, len({word_list(norm("text"))}) AS n FROM documents)
        SELECT source, count(*) FILTER (n > 0) AS n_pairs, sum({MISHEARD_EDITS}) AS edits, sum(n) AS ref_words,
        coalesce(sum({MISHEARD_EDITS}) / nullif(sum(n), 0), 0.0) AS wer FROM c GROUP BY 1""",
    "wer_conversations": f"""WITH RECURSIVE {TURN_EDITS} SELECT turn, count(*) FILTER (ref_words > 0) AS n_pairs,
        coalesce(sum(edits) FILTER (ref_words > 0), 0) AS edits, sum(ref_words) AS ref_words,
        coalesce(sum(edits) FILTER (ref_words > 0) / nullif(sum(ref_words), 0), 0.0) AS wer
        FROM edits GROUP BY turn""",
    "edits_per_pair": f"WITH RECURSIVE {TURN_EDITS} SELECT conv_id, turn, edits FROM edits",
    "wer_empty_refs": f"""WITH c AS (SELECT role, CASE WHEN role = 'system' THEN 0 ELSE
        len({word_list(norm("text"))}) END AS n FROM conversations)
        SELECT role, count(*) FILTER (n > 0) AS n_pairs, sum(n) AS edits, sum(n) AS ref_words,
        CASE WHEN sum(n) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS wer FROM c GROUP BY role""",
    "evaluate_hypotheses": f"""WITH c AS (SELECT len({word_list(norm("text"))}) AS n FROM documents
        JOIN labels USING (doc_id) WHERE quality >= 1)
        SELECT count(*) FILTER (n > 0) AS n_pairs, sum({MISHEARD_EDITS}) AS edits, sum(n) AS ref_words,
        sum({MISHEARD_EDITS}) / sum(n) AS wer FROM c""",
    "evaluate_files": f"""WITH c AS (SELECT 'doc_' || doc_id AS utt_id, quality, {norm("text")} AS heard,
        CASE WHEN quality >= 1 THEN {norm("text")} ELSE 'nothing' END AS ref
        FROM documents JOIN labels USING (doc_id) WHERE doc_id % 3 <> 0),
        w AS (SELECT *, string_split(heard, ' ') AS v FROM c),
        h AS (SELECT utt_id, quality, ref, array_to_string(list_filter(list_transform(range(1, len(v) + 1), lambda i:
            CASE WHEN i % 7 = 0 THEN NULL WHEN i % 11 = 0 THEN v[i] || 'Ω' ELSE v[i] END), lambda x: x IS NOT NULL), ' ') AS hyp
            FROM w),
        o AS (SELECT *, row_number() OVER (ORDER BY utt_id, hyp, ref) - 1 AS place FROM h),
        n AS (SELECT quality, len({word_list("ref")}) AS n, len({word_list("hyp")}) AS heard FROM o)
        SELECT 'hyp' AS side, place, hyp || ' (' || utt_id || ')' AS line FROM o
        UNION ALL SELECT 'ref', place, ref || ' (' || utt_id || ')' FROM o
        UNION ALL SELECT 'score', -1, count(*) FILTER (n > 0) || ' ' || sum(CASE WHEN quality >= 1 THEN {MISHEARD_EDITS}
            ELSE greatest(heard, 1) END)::BIGINT || ' ' || sum(n)::BIGINT FROM n""",
    "shuffle_rank": """SELECT o_orderkey, row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) - 1 AS rank
        FROM orders""",
    "assign_batches": """WITH r AS (SELECT conv_id || '-' || turn AS key FROM conversations), n AS (
        SELECT key, row_number() OVER (ORDER BY md5('42:' || key), key) - 1 AS place FROM r)
        SELECT key, place // 32 AS batch_id, place % 32 AS pos FROM n""",
    "pad_labels": f"""WITH {LABEL_ROWS}, b AS (SELECT conv_id, max(len(labels)) AS longest,
        bool_and(coalesce(labels[1] = 1, false)) AS cut FROM rows GROUP BY 1),
        p AS (SELECT key, conv_id, cut, list_concat(labels, list_transform(range(longest - len(labels)),
            lambda i: -100::BIGINT)) AS labels FROM rows JOIN b USING (conv_id))
        SELECT key, conv_id AS batch_id, array_to_string(CASE WHEN cut THEN labels[2:] ELSE labels END, ',') AS labels
        FROM p""",
    "restore_padding": f"""WITH {LABEL_ROWS} SELECT key, array_to_string(list_transform(labels,
        lambda n: CASE WHEN n % 2 = 0 THEN 0 ELSE n END), ',') AS labels FROM rows""",
    "wav_ingest": f"""WITH {AUDIO} SELECT path, n_chars + 44 AS n_bytes, text, n_chars / 100.0::DOUBLE AS duration,
        CASE WHEN lang = 'en' THEN 'test' ELSE 'train' END AS split,
        CASE WHEN lang = 'en' THEN 'test' ELSE 'part' END AS "OG_corpus", 'None' AS utt_id, 'None' AS lang,
        'None' AS task, 'None' AS translation_en, 'None' AS original_audio_id, 0.0::DOUBLE AS original_audio_offset
        FROM (SELECT * REPLACE (regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS text) FROM stored)
        WHERE reason IS NULL""",
    "wav_rejects": f"WITH {AUDIO} SELECT path, reason FROM stored WHERE reason IS NOT NULL",
    "audio_files_to_shards": f"""WITH {AUDIO}, files AS (SELECT *, regexp_replace(path, '[^/]*$', '') || CASE WHEN doc_id % 17 = 0 THEN '_'
        WHEN doc_id % 19 = 0 THEN '.' ELSE '' END || regexp_extract(path, '[^/]*$') AS place FROM stored),
        kept AS (SELECT *, row_number() OVER (ORDER BY place) - 1 AS n FROM files WHERE reason IS NULL AND doc_id % 23 <> 0)
        SELECT place AS path, n // 100 AS shard, regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS text,
        n_chars / 100.0::DOUBLE AS duration, CASE WHEN lang = 'en' THEN 'test' ELSE 'train' END AS split, n_chars + 44 AS n_bytes
        FROM kept""",
    "audio_files_rejects": f"""WITH {AUDIO}, {FILES} SELECT path, reason FROM files WHERE reason IS NOT NULL""",
    "ingest_audio_stream": f"WITH {AUDIO}, {FILES} SELECT path, reason FROM files",
    "training_order": """SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id::VARCHAR) - 1 AS place
        FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 > 0""",
    "places_in_buffer": f"""WITH s AS (SELECT o_orderkey, n % 5 AS reader, n // 5 AS i FROM (
        SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders)), {through_buffer("o_orderkey", 7)}
        SELECT o_orderkey, reader, place FROM through_buffer""",
    "buffered_streams": f"""WITH n AS (SELECT doc_id, n_chars, (row_number() OVER (ORDER BY doc_id) - 1) // 40 AS shard FROM documents),
        f AS (SELECT doc_id, n_chars, shard::VARCHAR AS shard, dense_rank() OVER (ORDER BY 'shard=' || shard || '/') - 1 AS file FROM n),
        s AS (SELECT doc_id, file % 3 AS reader, row_number() OVER (PARTITION BY file % 3 ORDER BY file, doc_id) - 1 AS i
        FROM f WHERE n_chars > 300), {through_buffer("doc_id", 42)}
        SELECT doc_id, reader::INTEGER AS reader, place FROM through_buffer""",
    "ingest_stream": f"""SELECT doc_id, {norm("text")} AS text, n_chars / 100.0::DOUBLE AS duration FROM documents
        WHERE n_chars / 100.0::DOUBLE <= 30.0""",
}
