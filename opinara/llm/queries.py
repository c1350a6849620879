"""The corpus operators over the test tables, and their meaning in DuckDB's SQL."""

from __future__ import annotations

import functools
import os

from opinara.llm.chat import conversation_digests, format_conversations
from opinara.llm.decontaminate import overlaps
from opinara.llm.exact_dedup import exact_duplicates
from opinara.llm.html_text import extract_text
from opinara.llm.jaccard_join import jaccard_components
from opinara.llm.language import identify_languages
from opinara.llm.mixing import mix
from opinara.llm.prefix_trie import prefix_trie
from opinara.llm.quality_rules import repetition_quality
from opinara.llm.token_counts import count_tokens
from opinara.llm.token_files import tokenized
from opinara.llm.toxicity import toxicity
from opinara.llm.whitening import component_rows, whiten
from opinara.session import cut_lineage

#: A conversation whose texts look like a template's control strings.
CONTROL_ROWS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def for_workers(query):
    """Let Python workers find this package where the driver found it."""
    @functools.wraps(query)
    def run(spark, *args):
        environment = spark.sparkContext.environment
        paths = environment.get("PYTHONPATH", "").split(os.pathsep)
        if ROOT not in paths:
            environment["PYTHONPATH"] = os.pathsep.join(p for p in [ROOT, *paths] if p)
        return query(spark, *args)
    return run


def op1_mixing(spark, sf_dir):
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op2_token_files(spark, sf_dir):
    return tokenized(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_decontamination(spark, sf_dir):
    return overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                    spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_exact_dedup(spark, sf_dir):
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op5_jaccard_join(spark, sf_dir):
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_token_counts(spark, sf_dir):
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op7_html_text(spark, sf_dir):
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_toxicity(spark, sf_dir):
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                    spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_language(spark, sf_dir):
    return identify_languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10_chat_formatting(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(CONTROL_ROWS, "conv_id long, turn long, role string, text string")
    return conversation_digests(cut_lineage(format_conversations(rows.unionByName(added))))


def op11_whitening(spark, sf_dir):
    return component_rows(whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def op12_quality_rules(spark, sf_dir):
    return repetition_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("node")


QUERIES = {f.__name__: for_workers(f) for f in (
    op1_mixing, op2_token_files, op3_decontamination, op4_exact_dedup, op5_jaccard_join, op6_token_counts, op7_html_text,
    op8_toxicity, op9_language, op10_chat_formatting, op11_whitening, op12_quality_rules, op13_prefix_trie)}

ORACLES = {
    "op1_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce('s' || source, 'n') AS key,
                len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
        t AS (SELECT key, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY 1),
        p AS (SELECT tokens / (SELECT sum(tokens)::DOUBLE FROM t) AS p FROM t WHERE tokens > 0),
        r AS (SELECT max(p) / min(p) AS r FROM p),
        -- the least multiple of 2^-30 at which no source is read more than twice
        a AS (SELECT CASE WHEN r <= 2 THEN 0.0::DOUBLE ELSE (SELECT min(k) / 2.0::DOUBLE ^ 30 FROM (
                  SELECT unnest([-1, 0, 1]) + ceil(2.0::DOUBLE ^ 30 * (1 - ln(2) / ln(r))) AS k)
                  WHERE pow(r, 1 - k / 2.0::DOUBLE ^ 30) <= 2) END AS a FROM r),
        w AS (SELECT key, pow(tokens::DOUBLE, a) AS power, tokens / pow(tokens::DOUBLE, a) AS once
              FROM t, a WHERE tokens > 0),
        b AS (SELECT key, tokens, greatest(ceil(tokens / 262144.0::DOUBLE), 1)::BIGINT AS blocks,
                  coalesce(round(power * (SELECT max(once) FROM w))::BIGINT, 0) AS budget
              FROM t LEFT JOIN w USING (key)),
        e AS (SELECT *, CASE WHEN tokens = 0 THEN 1 ELSE budget // tokens END AS whole FROM b),
        dealt AS (SELECT doc_id, source, key, n_tokens,
                      ('0x' || md5('17:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT % blocks AS block
                  FROM d JOIN b USING (key)),
        sums AS (SELECT key, block, sum(n_tokens)::BIGINT AS size FROM dealt GROUP BY 1, 2),
        epochs AS (SELECT key, block, size, whole, CASE WHEN tokens = 0 THEN 0 ELSE budget - whole * tokens END AS rest,
                       unnest(range(whole + 1)) AS epoch FROM sums JOIN e USING (key)),
        ranked AS (
            SELECT *, row_number() OVER o AS block_rank, sum(size) OVER (o ROWS UNBOUNDED PRECEDING) - size AS before
            FROM (SELECT *, ('0x' || md5('18:' || epoch || ':' || block || ':' || key)[1:8])::BIGINT AS x FROM epochs)
            WINDOW o AS (PARTITION BY key, epoch ORDER BY x, block)),
        used AS (SELECT *, epoch < whole OR rest - before >= size AS complete FROM ranked
                 WHERE epoch < whole OR rest > before),
        plan AS (
            SELECT doc_id, source, n_tokens, epoch, block, block_rank, complete, rest - before AS room,
                sum(n_tokens) OVER (PARTITION BY key, block, epoch
                    ORDER BY ('0x' || md5('19:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT, doc_id
                    ROWS UNBOUNDED PRECEDING) AS until
            FROM dealt JOIN used USING (key, block))
        SELECT doc_id, source, n_tokens, epoch, block, block_rank FROM plan WHERE complete OR until <= room""",
    "op4_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS digest
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY digest ORDER BY length(t) DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY digest) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY digest ORDER BY length(t) DESC, doc_id)
                   AS kept,
               digest AS text_sha256
        FROM d""",
    "op5_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
            FROM documents),
        s AS (
            SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []
                WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                ELSE [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END)) AS g
            FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g)
              WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM p JOIN n i ON i.doc_id = x JOIN n j ON j.doc_id = y
              WHERE 100 * c >= 85 * (i.n + j.n - c)),
        r(doc_id, root) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.root = l.x)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, min(root) AS component_id
        FROM documents LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY 1, 2""",
    "op10_chat_formatting": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (
            SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
                length(regexp_replace(replace(role, '\', '\\'), '(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g'))
                + length(regexp_replace(replace(text, '\', '\\'), '(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g'))
                + length('<|turn|>' || chr(10) || '<|end|>' || chr(10)) AS chars,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
            FROM t),
        b AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos) - tokens AS before FROM e),
        y AS (SELECT conv_id, min(pos) AS sys_pos, arg_min(tokens, pos) AS sys_tokens FROM b
              WHERE role = 'system' GROUP BY 1),
        c AS (SELECT b.*, sys_pos, greatest(512 - 128 - coalesce(sys_tokens, 0), 1) AS room
              FROM b LEFT JOIN y USING (conv_id)),
        v AS (SELECT *, (before + tokens - 1) // room AS stretch FROM c),
        u AS (SELECT *, 2 * stretch + (before >= stretch * room)::INT AS win FROM v),
        s AS (SELECT conv_id, win, min(pos) AS first, min(before) AS begins FROM u GROUP BY 1, 2),
        again AS (
            SELECT conv_id, sum(chars) AS chars FROM (
                SELECT u.conv_id, u.chars FROM u JOIN s ON s.conv_id = u.conv_id
                    AND s.first BETWEEN u.pos + 1 AND u.pos + 2
                WHERE s.begins - u.before <= 128 AND u.pos IS DISTINCT FROM u.sys_pos
                UNION ALL
                SELECT u.conv_id, u.chars FROM u JOIN s ON s.conv_id = u.conv_id
                WHERE u.pos = u.sys_pos AND s.first > u.pos) GROUP BY 1)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
            (sum(u.chars) + coalesce(max(again.chars), 0))::BIGINT AS formatted_chars
        FROM u LEFT JOIN again USING (conv_id) GROUP BY 1""",
    "op12_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
        words AS (SELECT rid, len(ws) AS n_words, coalesce(list_sum([length(x) FOR x IN ws]), 0)::BIGINT AS word_chars FROM w),
        lines AS (
            SELECT rid, line, count(*) AS n,
                coalesce(list_sum([length(x) FOR x IN regexp_extract_all(line, '[^\x20\x09-\x0D]+')]), 0)::BIGINT AS chars
            FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line),
        l AS (SELECT rid, sum(n)::BIGINT AS n_lines, sum(n - 1)::BIGINT AS n_dup_lines, sum((n - 1) * chars)::BIGINT AS dup_line_chars
              FROM lines GROUP BY rid),
        runs AS (
            SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS run FROM (
                SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, range(2, 11) r(n))),
        again AS (
            SELECT rid, n, i, length(run) - n + 1 AS chars, times, i > begins AS later FROM (
                SELECT *, count(*) OVER (PARTITION BY rid, n, run) AS times, min(i) OVER (PARTITION BY rid, n, run) AS begins
                FROM runs WHERE n <= 10) WHERE times > 1),
        top AS (SELECT rid, n, max(chars * times) AS chars FROM again WHERE n <= 4 GROUP BY rid, n),
        inside AS (
            SELECT rid, n, bool_or(later) AS later, place FROM (
                SELECT rid, n, later, unnest(range(i, i + n)) AS place FROM again WHERE n = 3 OR n >= 5 AND later) GROUP BY rid, n, place),
        cover AS (
            SELECT rid, n, count(*) AS words, sum(length(ws[place]))::BIGINT AS chars FROM inside JOIN w USING (rid) GROUP BY rid, n),
        c AS (SELECT rid, TOPS FROM (SELECT rid, n, 'top' AS kind, chars, 0 AS words FROM top
                                     UNION ALL SELECT rid, n, 'repeat', chars, words FROM cover) GROUP BY rid),
        f AS (
            SELECT doc_id, n_words, word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(dup_line_chars, 0) AS dup_line_chars,
                coalesce(n_repeat_words, 0) AS n_repeat_words, NAMES
            FROM d JOIN words USING (rid) LEFT JOIN l USING (rid) LEFT JOIN c USING (rid)),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
        SELECT *, NOT (base_failed OR 100 * n_dup_lines > 50 * n_lines OR 100 * dup_line_chars > 30 * word_chars OR RULES) AS kept
        FROM b"""
        .replace("TOPS", ", ".join(
            ["coalesce(max(words) FILTER (n = 3 AND kind = 'repeat'), 0)::BIGINT AS n_repeat_words",
             *[f"coalesce(max(chars) FILTER (n = {n} AND kind = 'top'), 0)::BIGINT AS top_{n}" for n in (2, 3, 4)],
             *[f"coalesce(max(chars) FILTER (n = {n} AND kind = 'repeat'), 0)::BIGINT AS repeat_{n}" for n in range(5, 11)]]))
        .replace("NAMES", ", ".join([*[f"coalesce(top_{n}, 0) AS top_{n}_chars" for n in (2, 3, 4)],
                                     *[f"coalesce(repeat_{n}, 0) AS repeat_{n}_chars" for n in range(5, 11)]]))
        .replace("RULES", " OR ".join([*[f"100 * top_{n}_chars > {p} * word_chars" for n, p in ((2, 30), (3, 28), (4, 26))],
                                       *[f"100 * repeat_{n}_chars > {35 - n} * word_chars" for n in range(5, 11)]])),
    "op13_prefix_trie": r"""
        WITH byte AS (
            SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY b) AS entries
            FROM range(256) r(b)),
        turns AS (
            SELECT conv_id AS c, role, words, length(role) || ':' || role || text AS whole,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS pos
            FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
                  FROM conversations WHERE conv_id IS NOT NULL)),
        h AS (
            SELECT c, xor(list_reduce(list_prepend(4294967295, [ord(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')]),
                lambda s, x: xor(s >> 8, entries[xor(s & 255, x) + 1])), 4294967295) % 4 AS h
            FROM (SELECT DISTINCT c FROM turns), byte),
        again AS (
            SELECT h.c, whole, words, 0 AS part, pos FROM h JOIN turns t ON t.c = h.c - h.c % 20 AND t.pos <= h
            UNION ALL SELECT h.c, whole, words, 1, pos FROM h JOIN turns t ON t.c = h.c AND t.pos > h),
        p AS (
            SELECT c, words, row_number() OVER o AS d, sha256(array_to_string(list(sha256(whole)) OVER (o ROWS UNBOUNDED PRECEDING), ' ')) AS key
            FROM again WINDOW o AS (PARTITION BY c ORDER BY part, pos)),
        pre AS (SELECT c, words, d, key, coalesce(lag(key) OVER (PARTITION BY c ORDER BY d), 'root') AS above FROM p
                UNION ALL SELECT c, 0, 0, 'root', NULL FROM h),
        n AS (SELECT key, d, any_value(above) AS above, any_value(words) AS words, count(*) AS n_convs, min(c) AS conv_id
              FROM pre GROUP BY key, d),
        kids AS (SELECT above AS key, count(*) AS n_children FROM n WHERE above IS NOT NULL GROUP BY 1),
        node AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (key)),
        below AS (
            SELECT pre.key, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * u.words)::BIGINT AS saved_tokens
            FROM node u JOIN pre ON pre.c = u.conv_id AND pre.d <= u.d GROUP BY pre.key),
        ends AS (SELECT key, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
                 FROM pre WHERE (c, d) IN (SELECT (c, max(d)) FROM pre GROUP BY c) GROUP BY key)
        SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, node.n_children, n_leaves, saved_tokens,
            sha256(coalesce(ids, '')) AS ends_sha256
        FROM node JOIN below USING (key) LEFT JOIN ends USING (key) LEFT JOIN n up ON up.key = node.above""",
}
