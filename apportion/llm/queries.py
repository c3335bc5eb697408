"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from apportion.llm import maxplus
from apportion.llm.active_lloyd import code_digests, encode_vectors
from apportion.llm.ads_ann import nearest
from apportion.llm.chat import conversation_digests, format_conversations, with_marked_conversation
from apportion.llm.common import table, tokenizer_folder
from apportion.llm.improbable_digest import edited_digests
from apportion.llm.lbl import score_documents
from apportion.llm.line_quality import line_quality
from apportion.llm.lpf_dedup import repeat_digests
from apportion.llm.minmax_dedup import MinMaxRules, near_duplicates
from apportion.llm.nbsvm import score_quality
from apportion.llm.packing import pack_power_of_two
from apportion.llm.sharding import shard_by_slots
from apportion.llm.whitening import whitened_components


def q_op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without bytes covered by 200-byte strings that start more than once."""
    return repeat_digests(table(spark, sf_dir, "documents"), length=200, keep="none")


def q_op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning verdicts of all documents."""
    return line_quality(table(spark, sf_dir, "documents"), with_text=False)


def q_op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to pieces and decoded again: counts, scores and checksums of both."""
    vocabulary = f"{tokenizer_folder()}/piece_bpe_32k.model"
    encoded = maxplus.encode(table(spark, sf_dir, "documents"), vocabulary)
    return maxplus.digests(encoded, vocabulary)


def q_op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth embedding, by adaptive dimension scan."""
    return nearest(table(spark, sf_dir, "embeddings"))


def q_op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by naive Bayes support vectors."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, by fixed virtual slots."""
    return shard_by_slots(table(spark, sf_dir, "documents"), n_shards=40)


def q_op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations (and conversation -7) formatted with their loss mask, digested from the output."""
    return conversation_digests(format_conversations(with_marked_conversation(table(spark, sf_dir, "conversations"))))


def q_op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), MinMaxRules(words=2))


def q_op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as power-of-two pieces of at most 4096 ids."""
    return pack_power_of_two(table(spark, sf_dir, "documents"), f"{tokenizer_folder()}/word_bpe_49k.json", with_ids=False)


def q_op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all documents under the log-bilinear model, and their unigram base."""
    return score_documents(table(spark, sf_dir, "documents"))


def q_op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as 16 codes of 64 entries after two active-entry Lloyd rounds."""
    return code_digests(encode_vectors(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2))


def q_op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the four whitened directions of largest variance."""
    return whitened_components(table(spark, sf_dir, "embeddings"), components=4)


def q_op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and their likeness."""
    return edited_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_previous_factors": q_op1,
    "op2_line_quality": q_op2,
    "op3_max_plus_pieces": q_op3,
    "op4_adaptive_scan": q_op4,
    "op5_nb_support_vectors": q_op5,
    "op6_virtual_slots": q_op6,
    "op7_chat_template": q_op7,
    "op8_min_max_hash": q_op8,
    "op9_power_of_two_packing": q_op9,
    "op10_log_bilinear": q_op10,
    "op11_active_lloyd": q_op11,
    "op12_eigen_whitening": q_op12,
    "op13_improbable_digest": q_op13,
}

ORACLE_SQL: dict[str, str] = {
    # texts as hex, two signs per byte; a window is known by its hash
    "op1_previous_factors": """
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
        ), w AS (
            SELECT doc_id, i, hash(substr(h, 2 * i + 1, 400)) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM d)
        ), c AS (
            SELECT k FROM w GROUP BY k HAVING count(*) > 1
        ), m AS (
            SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w JOIN c USING (k)
        ), g AS (
            SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM m
        ), spans AS (
            SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY doc_id, s
        ), pieces AS (
            SELECT doc_id, a AS place, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM spans
            UNION ALL SELECT doc_id, max(n), coalesce(max(b), 0), max(n) FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY place) AS k FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
        ), sums AS (
            SELECT doc_id, sum(b - a) AS removed, count(*) AS runs FROM spans GROUP BY doc_id
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
               coalesce(runs, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
        FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)""",
    "op8_min_max_hash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda x: x <> '') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM w)
            UNION ALL SELECT doc_id, w[1] FROM w WHERE len(w) = 1
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), links AS (
            SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
            JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
        ), reach AS (
            SELECT doc_id, doc_id AS r FROM documents UNION SELECT doc_id, b FROM reach JOIN links ON a = r
        )
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
        FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)""",
    "op2_line_quality": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), three AS (
            SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
        ), twice AS (
            SELECT doc_id, a, b, c FROM three GROUP BY doc_id, a, b, c HAVING count(*) > 1
        ), repeats AS (
            SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM three JOIN twice USING (doc_id, a, b, c), range(3) r(k) GROUP BY doc_id
        ), lines AS (
            SELECT doc_id, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
                   list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                   length(regexp_replace(line, '[^\p{L}]', '', 'g')) AS cased, length(regexp_replace(line, '[^\p{Lu}]', '', 'g')) AS capitals
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        ), judged AS (
            SELECT doc_id, line, chars,
                   length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > 0.3 * len(w)
                   OR len(list_filter(w, lambda x: x IN ('|', '||', '/', '//', '>', '>>', '»', '›', '·', '•', '-', '–', '—', '*', '←', '→'))) > 0.2 * len(w)
                   OR (2 * len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x))) > len(w) AND cased >= 12 AND capitals > 0.8 * cased)
                   OR (len(w) <= 30 AND regexp_matches(lower(line), 'cookie|privacy policy|terms of (?:use|service)|all rights reserved|copyright ©|©|javascript|lorem ipsum|click here|read more|sign (?:in|up)|log ?in|subscribe|newsletter|back to top|share (?:this|on)|follow us|skip to content'))
                   OR (len(w) <= 6 AND NOT regexp_matches(line, '[.!?:;…。！？]["''”’»)\]]*[\x20\x09-\x0D]*$')) AS failed
            FROM lines
        ), per AS (
            SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
                   count(*) FILTER (failed) AS n_failed_lines, coalesce(sum(chars) FILTER (failed), 0) AS lost
            FROM judged GROUP BY doc_id
        ), base AS (
            SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
                   coalesce(n_failed_lines, 0) AS n_failed_lines, coalesce(lost, 0) AS lost
            FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN per USING (doc_id)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= 0.3 * word_chars AS kept,
               n_lines, n_failed_lines, CAST(word_chars - lost AS BIGINT) AS kept_word_chars
        FROM base""",
    # formatted_chars: the marks of a turn have 24 code points, and each opening inside a text or role gets one more
    "op7_chat_template": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), marked AS (
            SELECT *, length(regexp_replace(role || chr(10) || text, '<(\\*)\|', '<\\\1|', 'g')) - 1 AS chars FROM said
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars + 24) AS BIGINT) AS formatted_chars
        FROM marked GROUP BY conv_id""",
    # vectors of 64 components; a part's entry and distance travel as distance * 64 + entry, whose minimum is the nearest, ties to the lower
    "op11_active_lloyd": """
        WITH k AS (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
                   list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ), p AS (
            SELECT r, part, x[4 * part + 1] AS a, x[4 * part + 2] AS b, x[4 * part + 3] AS c, x[4 * part + 4] AS d FROM k, range(16) t(part)
        ), b0 AS (
            SELECT part, r - 1 AS entry, a, b, c, d FROM p WHERE r <= 64
        ), a0 AS (
            SELECT r, part, min(((p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) + (p.c - q.c) * (p.c - q.c) + (p.d - q.d) * (p.d - q.d)) * 64 + entry) AS m
            FROM p JOIN b0 q USING (part) GROUP BY r, part
        ), m1 AS (
            SELECT part, m % 64 AS entry, floor(sum(a) / count(*)) AS a, floor(sum(b) / count(*)) AS b, floor(sum(c) / count(*)) AS c, floor(sum(d) / count(*)) AS d
            FROM a0 JOIN p USING (r, part) GROUP BY 1, 2
        ), b1 AS (
            SELECT part, entry, CAST(coalesce(m1.a, b0.a) AS BIGINT) AS a, CAST(coalesce(m1.b, b0.b) AS BIGINT) AS b,
                   CAST(coalesce(m1.c, b0.c) AS BIGINT) AS c, CAST(coalesce(m1.d, b0.d) AS BIGINT) AS d
            FROM b0 LEFT JOIN m1 USING (part, entry)
        ), a1 AS (
            SELECT r, part, min(((p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) + (p.c - q.c) * (p.c - q.c) + (p.d - q.d) * (p.d - q.d)) * 64 + entry) AS m
            FROM p JOIN b1 q USING (part) GROUP BY r, part
        ), m2 AS (
            SELECT part, m % 64 AS entry, floor(sum(a) / count(*)) AS a, floor(sum(b) / count(*)) AS b, floor(sum(c) / count(*)) AS c, floor(sum(d) / count(*)) AS d
            FROM a1 JOIN p USING (r, part) GROUP BY 1, 2
        ), b2 AS (
            SELECT part, entry, CAST(coalesce(m2.a, b1.a) AS BIGINT) AS a, CAST(coalesce(m2.b, b1.b) AS BIGINT) AS b,
                   CAST(coalesce(m2.c, b1.c) AS BIGINT) AS c, CAST(coalesce(m2.d, b1.d) AS BIGINT) AS d
            FROM b1 LEFT JOIN m2 USING (part, entry)
        ), a2 AS (
            SELECT r, part, min(((p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) + (p.c - q.c) * (p.c - q.c) + (p.d - q.d) * (p.d - q.d)) * 64 + entry) AS m
            FROM p JOIN b2 q USING (part) GROUP BY r, part
        ), coded AS (
            SELECT r, string_agg(printf('%02x', m % 64), '' ORDER BY part) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a2 GROUP BY r
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(concat_ws(',', a, b, c, d), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
        FROM coded JOIN k USING (r)""",
}
