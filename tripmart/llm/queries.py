"""One query per operator over its whole table, and an SQL text where SQL can express it.

The operators keep their own interfaces; a query only derives the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.chat import render_chats
from tripmart.llm.decontaminate import contained_items
from tripmart.llm.embeddings import near_vectors
from tripmart.llm.htmltext import extract_text, train_pages
from tripmart.llm.interactions import audit_filters
from tripmart.llm.langid import identify, train
from tripmart.llm.licenses import TEMPLATES, TEXTS, scan_licenses, template_bigrams
from tripmart.llm.neardup import near_duplicates
from tripmart.llm.packing import pack
from tripmart.llm.repair import damage, repair_conversations
from tripmart.llm.substring import remove_repeats
from tripmart.llm.tokencount import count_tokens
from tripmart.llm.tokenfiles import checksums, read_tokens, write_tokens
from tripmart.sources.scratch import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text leaves remainder 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_chats(_table(spark, sf_dir, "conversations"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    out = identify(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    out = extract_text(pages, train_pages(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the 32k vocabulary; the score is rounded, as sums of floats depend on their order."""
    out = count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_words", "n_tokens", F.round("score", 3).alias("score"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 13 words; the digest is of the kept words joined by one space."""
    out = remove_repeats(_table(spark, sf_dir, "documents"), min_words=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of two words, links from 80 percent on."""
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 4096 ids; the ids themselves are left out, their checksums stay."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(_table(spark, sf_dir, "documents"), path, end_id=2, window=4096, with_ids=False)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations and their cheapest repair."""
    damaged, present = damage(_table(spark, sf_dir, "conversations"))
    return repair_conversations(damaged, present=present)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents below the scratch folder, read back."""
    path = scratch_path(spark, "tokens")
    write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return checksums(read_tokens(spark, path))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_decontaminate": op2_decontaminate,
    "op3_language_id": op3_language_id,
    "op4_html_text": op4_html_text,
    "op5_license_scan": op5_license_scan,
    "op6_token_counts": op6_token_counts,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_near_dedup": op8_near_dedup,
    "op9_packing": op9_packing,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_files": op12_token_files,
    "op13_filter_audit": op13_filter_audit,
}

_WORDS = r"list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda x: x <> '')"
_SHINGLES = "list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"

_OP1 = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
talks AS (
    SELECT conv_id, list({'r': role, 't': text} ORDER BY turn, role) AS said,
           string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), ''
                      ORDER BY turn, role) AS chat
    FROM turns GROUP BY conv_id),
same AS (SELECT said, min(conv_id) AS conv_id, min(chat) AS chat, count(*) AS n_copies FROM talks GROUP BY said)
SELECT conv_id, CAST(0 AS BIGINT) AS part, CAST(len(said) AS BIGINT) AS n_turns, n_copies, chat
FROM same a
WHERE NOT EXISTS (
    SELECT 1 FROM same b WHERE b.said[1] = a.said[1] AND len(b.said) > len(a.said) AND b.said[1:len(a.said)] = a.said)
"""

_OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents),
b AS (SELECT min(item_id) AS item_id, w FROM
      (SELECT item_id, {_WORDS.format(text="text")} AS w FROM benchmark) GROUP BY w HAVING len(w) >= 5),
item_shingles AS (SELECT item_id, len(s) AS n, unnest(s) AS s FROM (SELECT item_id, {_SHINGLES} AS s FROM b)),
doc_shingles AS (SELECT DISTINCT doc_id, unnest({_SHINGLES}) AS s FROM d WHERE len(w) >= 5),
hits AS (SELECT doc_id, item_id, n, count(*) AS shared FROM doc_shingles JOIN item_shingles USING (s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_item_shingles, shared AS n_shared,
       CAST(shared AS DOUBLE) / n AS containment
FROM hits WHERE shared >= ceil(round(n * 0.8, 6))
"""


def _license_sql(threshold: float = 0.8) -> str:
    """Every passage against every notice, and every document against every licence text, of which it has a bigram."""
    quoted = [(name, [x.replace("'", "''") for x in template_bigrams(text)]) for name, text in (*TEMPLATES, *TEXTS)]
    values = ", ".join(
        "({}, '{}', {}, [{}])".format(k, n, k >= len(TEMPLATES), ", ".join(f"'{x}'" for x in b))
        for k, (n, b) in enumerate(quoted)
    )
    return f"""
WITH templates(k, license, whole, bigrams) AS (VALUES {values}),
parts AS (
    SELECT doc_id, text AS part, true AS whole FROM documents
    UNION ALL
    SELECT doc_id, unnest(list_distinct(list_concat(list_concat(
        string_split(text, chr(10)),
        string_split(regexp_replace(text, '([.!?;])\\s+', '\\1' || chr(10), 'g'), chr(10))),
        string_split_regex(text, '\\n\\s*\\n')))) AS part, false
    FROM documents),
folded AS (SELECT doc_id, whole, {_WORDS.format(text="part")} AS w FROM parts),
passages AS (
    SELECT DISTINCT doc_id, whole, list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS bigrams
    FROM folded WHERE len(w) > 1),
named AS (SELECT row_number() OVER () AS id, doc_id, whole, bigrams FROM passages),
pairs AS (
    SELECT id, doc_id, whole, len(bigrams) AS a, unnest(bigrams) AS g FROM named),
wanted AS (SELECT k, license, whole, len(bigrams) AS b, unnest(bigrams) AS g FROM templates),
scored AS (
    SELECT id, doc_id, k, license, 2.0::DOUBLE * count(*) / (a + b) AS dice
    FROM pairs JOIN wanted USING (g, whole) GROUP BY id, doc_id, k, license, a, b),
matched AS (
    SELECT s.doc_id, license, dice, named.bigrams FROM scored s JOIN named ON s.id = named.id)
SELECT doc_id, license, max(dice) AS dice, count(DISTINCT bigrams) AS n_matches
FROM matched WHERE dice >= {threshold} GROUP BY doc_id, license
"""


_OP13 = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM t),
f AS (
    SELECT part,
        len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
        regexp_matches(text, '[#$%&*|]') AS d,
        EXISTS (SELECT 1 FROM t o WHERE o.text = w.text AND o.doc_id < w.doc_id) AS e,
        EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.quality = 1) AS good,
        EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.toxic = 1) AS toxic
    FROM w),
m AS (
    SELECT part, good, toxic, count(*) AS n,
        CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
        || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails
    FROM f GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
    SELECT p.x || q.x || r.x || s.x || u.x AS filter_order
    FROM letters p, letters q, letters r, letters s, letters u
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
steps AS (
    SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
marked AS (
    SELECT part, filter_order, step, own, good, toxic, n, contains(fails, own) AS failed, fails = own AS alone,
        length(translate(fails, before, '')) < length(fails) AS gone
    FROM m, steps),
counted AS (
    SELECT part, filter_order, step, own,
        sum(CASE WHEN NOT failed AND NOT gone THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN failed AND NOT gone THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN failed AND gone THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN failed AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
        sum(CASE WHEN failed AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
    FROM marked GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
    redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
    toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""


ORACLES: dict[str, str] = {
    "op1_chat_format": _OP1,
    "op2_decontaminate": _OP2,
    "op5_license_scan": _license_sql(),
    "op13_filter_audit": _OP13,
}
