"""The queries of this subpackage, under the names of the driver contract, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, drift, langid, pii, pivot_search, quality, repeats, secret_scan, simhash, toxicity, trie
from .textops import table

#: The vocabulary files are never copied; the path is a parameter.
TOKENIZER = "byte_bpe_50k.json"

CLIENT_COLUMNS = ("client_id", "master_id", "source", "updated_at", "name", "email", "city", "nation_id", "segment", "balance")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table(sf_dir, "documents"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(table(sf_dir, "conversations")).select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.format_chats(rows))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(toxicity.training_rows(docs, spark.read.parquet(table(sf_dir, "labels"))))
    return toxicity.classify(docs, model)


def op3_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(spark.read.parquet(table(sf_dir, "embeddings")), F.col("id") % 50 == 0)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.classify(docs, langid.train(langid.training_rows(docs))).drop("spans")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(documents(spark, sf_dir), spark.read.parquet(table(sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(documents(spark, sf_dir), tokenizer_path())
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    counts = {f"n_{k}": F.size(F.filter("base", _is(k))).cast("long") for k in secret_scan.KINDS[:3]}
    return found.select("doc_id", *(c.alias(n) for n, c in counts.items()), F.sha2(secret_scan.listing(F.col("base")), 256).alias("base_sha256"), secret_scan.listing(F.col("spans")).alias("spans"))


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.extract(docs, pii.learn(docs))
    counts = [F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS[:4]]
    base = F.filter("spans", lambda s: s["kind"] != "context")
    return found.select("doc_id", *counts, F.sha2(secret_scan.listing(base), 256).alias("base_sha256"), secret_scan.listing(F.col("spans")).alias("spans"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(quality.training_rows(docs, spark.read.parquet(table(sf_dir, "labels"))))
    return quality.classify(docs, model)


def op12_drifted_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = spark.read.parquet(table(sf_dir, "clients"))
    return drift.rewritten(clients.select(*CLIENT_COLUMNS[:7], F.col("nation_id").cast("long"), *CLIENT_COLUMNS[8:]), "client_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(table(sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_toxicity": op2_toxicity,
    "op3_pivot_search": op3_pivot_search,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_simhash": op6_simhash,
    "op7_bpe": op7_bpe,
    "op8_secret_scan": op8_secret_scan,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_pii": op10_pii,
    "op11_quality": op11_quality,
    "op12_drifted_rewrite": op12_drifted_rewrite,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op1_chat_format": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v(conv_id, turn, role, text)),
marked AS (
  SELECT *, length(role) + length(text) + 15 + CASE WHEN ends_with(text, ':') OR ends_with(text, '###') THEN 1 ELSE 0 END
    + len(regexp_extract_all(role || chr(0) || text, '\\')) + len(regexp_extract_all(role || chr(0) || text, '### ')) + len(regexp_extract_all(role || chr(0) || text, ': '))
    + len(regexp_extract_all(role || chr(0) || text, ' </turn>\n')) AS n,
    lag(role) OVER w AS before, w1.k
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM rows) w1
  WINDOW w AS (PARTITION BY conv_id ORDER BY k))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars,
  CAST(sum(CASE WHEN before IS NULL AND role IN ('system', 'user') OR before = 'system' AND role = 'user' OR before = 'user' AND role = 'assistant'
    OR before = 'assistant' AND role = 'user' THEN 0 ELSE 1 END) AS BIGINT) AS n_out_of_order
FROM marked GROUP BY conv_id""",
    "op3_pivot_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op5_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[a:a + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS a FROM i WHERE len(w) > 0)),
s AS (SELECT DISTINCT n FROM g),
x AS (SELECT r, n, a, array_to_string(w[a:a + n - 1], ' ') AS gram FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM d, s WHERE len(w) >= n)),
h AS (SELECT x.r, x.a, x.n, g.item_id FROM x JOIN g ON x.gram = g.gram AND x.n = g.n),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(a, a + n)) AS p FROM (SELECT DISTINCT r, a, n FROM h)) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
  sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)""",
    "op9_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, a, array_to_string(w[a:a + 34], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS a FROM d WHERE len(w) >= 35)),
c AS (SELECT DISTINCT r, unnest(range(a, a + 35)) AS p FROM x JOIN (SELECT k FROM x GROUP BY k HAVING count(*) > 1) USING (k)),
e AS (SELECT r, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM d),
k AS (SELECT e.r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM e ANTI JOIN c USING (r, p) GROUP BY e.r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)""",
    "op13_prefix_trie": r"""
WITH t AS (
  SELECT conv_id AS c, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS s, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, list(s ORDER BY k) AS s FROM t GROUP BY c),
h AS (
  -- crc32 of the decimal id, byte by byte and bit by bit
  SELECT c, s, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda b: [CAST(ord(b) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384::BIGINT) ELSE xor(a, x) >> 1 END), 4294967295::BIGINT) % 9 AS h FROM l),
p AS (SELECT h.c, list_concat(coalesce(b.s, [])[1:h.h], h.s[h.h + 1:]) AS s FROM h LEFT JOIN l b ON b.c = h.c - h.c % 5),
m AS (SELECT c, len(s) AS n, d, CAST(s[1:d] AS VARCHAR) || d AS key, CASE WHEN d > 0 THEN CAST(s[1:d - 1] AS VARCHAR) || (d - 1) END AS parent, coalesce(strlen(s[d].x), 0) AS size
  FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM p)),
v AS (
  SELECT key, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256 FROM m GROUP BY key),
k AS (SELECT parent AS key, count(*) AS n_children FROM v WHERE parent IS NOT NULL GROUP BY parent),
w AS (SELECT v.*, coalesce(k.n_children, 0) AS n_children FROM v LEFT JOIN k USING (key)),
u AS (
  SELECT a.key, CAST(sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum(w.saved) AS BIGINT) AS saved_tokens
  FROM m a JOIN m b ON a.c = b.c AND b.d >= a.d JOIN w ON w.key = b.key AND w.conv_id = b.c GROUP BY a.key)
SELECT w.conv_id, w.depth, f.conv_id AS parent_conv_id, w.n_convs, w.n_children, u.n_leaves, u.saved_tokens, w.ends_sha256
FROM w JOIN u USING (key) LEFT JOIN v f ON f.key = w.parent""",
}
