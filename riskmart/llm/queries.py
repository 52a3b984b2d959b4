"""One query for each operator, over the whole of its table, and SQL to check those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import (
    bpe,
    chat,
    chat_repair,
    decontaminate,
    exact_dup,
    filter_audit,
    license_scan,
    near_dup,
    packing,
    secret_scan,
    simhash,
    token_count,
    toxicity,
)
from riskmart.llm.words import ROW
from riskmart.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = lambda spark, folder: function(tune(spark), folder)
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"), ["doc_id"])


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    results = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode(docs, BYTE_BPE, public_tokenizers.PATTERN, results=results).drop("text")


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_count.count_tokens(docs, ["doc_id"], BYTE_BPE, public_tokenizers.PATTERN)


@query
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    # A source is an owner; its texts in one language are a repository.
    docs = docs.withColumn("repository", F.concat_ws("/", "source", "lang"))
    return secret_scan.scan(docs, "doc_id", repository="repository", owner="source")


@query
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dup.exact_groups(table(spark, folder, "documents"))


ORACLE["op10_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_groups(table(spark, folder, "documents")).drop(ROW)


ORACLE["op9_near_dedup"] = """
WITH RECURSIVE words AS (
  SELECT doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM words, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i)
  WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l USING (doc_id) LEFT JOIN sizes s USING (doc_id)
"""


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.find_items(docs, items, ["doc_id"])


ORACLE["op6_decontaminate"] = """
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), doc_shingles AS (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s, min(i) - 1 AS start
  FROM doc_words, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i)
  WHERE len(w) > 0 GROUP BY doc_id, s
), item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM item_words, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i)
  WHERE len(w) > 0
), sizes AS (
  SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id
)
SELECT d.doc_id, i.item_id, n_shingles, count(*) AS matched, min(start) AS first_word
FROM doc_shingles d JOIN item_shingles i USING (s) JOIN sizes USING (item_id)
GROUP BY d.doc_id, i.item_id, n_shingles
HAVING 100 * count(*) >= 75 * n_shingles
"""


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


ORACLE["op4_chat_format"] = """
WITH named AS (
  -- A turn without an id is a conversation of its own.
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () ELSE 0 END AS own, turn, role, text
  FROM conversations
), placed AS (
  SELECT conv_id, own, row_number() OVER w AS place, turn, role, text,
         string_agg(coalesce(role, chr(3)) || chr(1) || coalesce(text, chr(3)) || chr(2), '') OVER w AS so_far,
         count(*) OVER (PARTITION BY conv_id, own) AS n_turns
  FROM named
  WINDOW w AS (PARTITION BY conv_id, own ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), ends AS (
  SELECT so_far, n_turns, min(conv_id) AS conv_id, min(own) AS own, count(*) AS n_copies
  FROM placed WHERE place = n_turns GROUP BY so_far, n_turns
), whole AS (
  SELECT * FROM ends WHERE so_far NOT IN (SELECT so_far FROM placed WHERE place < n_turns)
)
SELECT whole.conv_id, whole.n_turns, n_copies,
       string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
                  ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS rendered
FROM whole JOIN placed ON placed.conv_id IS NOT DISTINCT FROM whole.conv_id AND placed.own = whole.own
GROUP BY whole.conv_id, whole.own, whole.n_turns, n_copies
"""


@query
def op8_pack_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


ORACLE["op12_filter_audit"] = """
WITH RECURSIVE orders(filter_order) AS (
  SELECT ''
  UNION ALL
  SELECT filter_order || f FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS t(f)
  WHERE NOT contains(filter_order, f)
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, generate_series(1, 5) AS g(step) WHERE length(filter_order) = 5
), words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents
), fails AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS failing
  FROM words
), marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), kinds AS (
  SELECT part, failing, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM fails LEFT JOIN marks USING (doc_id) GROUP BY ALL
), outcomes AS (
  SELECT part, filter_order, step, f, n, good, toxic, failing,
         contains(failing, f) AS fails_now,
         length(translate(earlier, failing, '')) < length(earlier) AS gone
  FROM kinds CROSS JOIN steps
), counted AS (
  SELECT part, filter_order, step, f,
         CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails_now), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (NOT gone AND fails_now), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (gone AND fails_now), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (failing = f), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n) FILTER (NOT gone AND fails_now AND good), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n) FILTER (NOT gone AND fails_now AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM outcomes GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


@query
def op13_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"))


@query
def op11_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    return chat_repair.repair(table(spark, folder, "conversations"))


def _state_sql(options: list[tuple[str, str, int, str]]) -> str:
    """The least of the ways into a state: (state before, condition, cost, letter and what it writes)."""
    ways = ", ".join(
        f"CASE WHEN {condition} AND {state} IS NOT NULL THEN {{'k': lpad(CAST(CAST({state}.k[:9] AS INT) + {cost} AS VARCHAR), 9, '0')"
        f" || {state}.k[10:] || '{letter}', 't': {state}.t{written}}} END"
        for state, condition, cost, letter, written in options
    )
    return f"list_sort(list_filter([{ways}], lambda x: x IS NOT NULL))[1]"


def _insert_sql(before: str, role: str) -> list[tuple]:
    return [(before, "true", 2, "I", f" || [{role!r} || ':']")]


def _row_states_sql() -> str:
    """States after a row, from the states n, s, u, a before it with inserts already made."""
    stays = "NOT must_go"
    keep_row, cost = " || [role || ':' || text]", "CAST(cut AS INT)"
    reroled = {r: f" || ['{r}:' || text]" for r in ("user", "assistant")}

    def delete(state: str) -> tuple:
        return (state, "true", 3, "D", "")

    into_u = [delete("u")]
    for state in "nsa":
        into_u += [(state, f"{stays} AND initial = 'u'", cost, "K", keep_row), (state, stays, f"2 + {cost}", "R", reroled["user"])]
    into_a = [delete("a"), ("u", f"{stays} AND initial = 'a'", cost, "K", keep_row), ("u", stays, f"2 + {cost}", "R", reroled["assistant"])]
    into_s = [delete("s"), ("n", f"{stays} AND initial = 's'", cost, "K", keep_row)]
    return (
        f"{_state_sql([delete('n')])} AS n, {_state_sql(into_s)} AS s, {_state_sql(into_u)} AS u, {_state_sql(into_a)} AS a"
    )


def _inserted_sql(source: str, columns: str) -> str:
    """The states n, s, u, a of ``source`` with up to two inserts."""
    same = ("true", 0, "")
    keep_u, keep_a = ("u", *same, ""), ("a", *same, "")
    once_u = _state_sql([keep_u, *_insert_sql("n", "user"), *_insert_sql("s", "user"), *_insert_sql("a", "user")])
    once_a = _state_sql([keep_a, *_insert_sql("u", "assistant")])
    return (
        f"SELECT {columns}, n, s, u, {once_a} AS a FROM "
        f"(SELECT {columns}, n, s, {once_u} AS u, a FROM {source})"
    )


_NO_STATE = "CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR[]))"

# Damage by CRC-32 over bytes, faults by windows, then the costs of the four states row by row, each with its
# least audit and what it writes. Within a gap two inserts are enough.
ORACLE["op11_chat_repair"] = f"""
WITH RECURSIVE bytes AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), acted AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           CAST(list_transform(string_split(name, ''), lambda c: ord(c)) AS BIGINT[])),
           lambda c, b: xor(c >> 8, crc[CAST(xor(c & 255, b) AS INT) + 1])), 4294967295) % 20 AS act
  FROM keyed, bytes
), damaged AS (
  SELECT conv_id, turn, CASE WHEN act = 4 THEN 'user' ELSE role END AS role,
         CASE act WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM acted, unnest(CASE WHEN act = 3 THEN [1, 2] ELSE [1] END) AS copies(c)
  WHERE act <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS ending
  FROM damaged
), faulty AS (
  SELECT *, left(role, 1) AS initial,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS pair,
         ending = '' AS is_blank,
         ending <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS is_duplicate,
         right(ending, 1) NOT IN ('.', '!', '?') AS stops
  FROM placed
), rows AS (
  SELECT *, is_blank OR is_duplicate AS must_go, stops AND NOT is_blank AND NOT is_duplicate AS cut FROM faulty
), totals AS (
  SELECT conv_id, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_duplicate) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id
), states AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS place, {{'k': '000000000', 't': CAST([] AS VARCHAR[])}} AS n,
         {_NO_STATE} AS s, {_NO_STATE} AS u, {_NO_STATE} AS a
  FROM totals
  UNION ALL
  SELECT conv_id, place, {_row_states_sql()} FROM (
    SELECT o.conv_id, o.n, o.s, o.u, o.a, r.place, r.role, r.text, r.initial, r.must_go, r.cut
    FROM ({_inserted_sql("states", "conv_id, place")}) o
    JOIN rows r ON r.conv_id IS NOT DISTINCT FROM o.conv_id AND r.place = o.place + 1)
), last AS (
  SELECT conv_id, list_sort(list_filter([n, a], lambda x: x IS NOT NULL))[1] AS best FROM (
    {_inserted_sql("(SELECT s.* FROM states s JOIN totals t ON s.conv_id IS NOT DISTINCT FROM t.conv_id AND s.place = t.n_rows)", "conv_id")})
), every AS (
  SELECT DISTINCT conv_id FROM conversations
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(CAST(best.k[:9] AS INT), 0) AS BIGINT) AS cost, coalesce(best.k[10:], '') AS audit,
       sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM every e LEFT JOIN totals t ON e.conv_id IS NOT DISTINCT FROM t.conv_id
LEFT JOIN last l ON e.conv_id IS NOT DISTINCT FROM l.conv_id
"""
