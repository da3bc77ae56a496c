"""One query per operator over the corpus tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.conversation_trie import conversation_trie
from tabprep.llm.decontaminate import overlaps
from tabprep.llm.divergence import divergence
from tabprep.llm.fingerprints import neighbour_likeness
from tabprep.llm.language import identify_language
from tabprep.llm.packing import pack
from tabprep.llm.pii import BASE, find_pii
from tabprep.llm.quality import quality
from tabprep.llm.shared import read_table, temporary_folder
from tabprep.llm.sharding import shard_by_bytes
from tabprep.llm.simhash import near_duplicates
from tabprep.llm.token_counts import token_counts
from tabprep.llm.token_file import read_token_file, write_token_file
from tabprep.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_GRAMS = "unnest(range(1, len(w) - n + 2)) AS i, unnest([array_to_string(w[j:j + n - 1], ' ') for j in range(1, len(w) - n + 2)]) AS g"
ORACLE["op4_decontamination"] = f"""WITH
  d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
  b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
  bn AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
  bg AS (SELECT DISTINCT item, n, g FROM (SELECT item, n, {_GRAMS} FROM bn)),
  dg AS (SELECT r, n, {_GRAMS} FROM d, (SELECT DISTINCT n FROM bn) WHERE len(w) >= n),
  hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (
    SELECT r, unnest(range(i, i + n)) AS p FROM dg SEMI JOIN bg USING (n, g)) GROUP BY r),
  found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
    FROM dg JOIN bg USING (n, g) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN found USING (r)"""


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_likeness(read_table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


@query
def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_token_file(read_table(spark, sf_dir, "documents"), temporary_folder(spark, "token-file"))
    return read_token_file(spark, folder)


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(read_table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read_table(spark, sf_dir, "documents"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(k) for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(read_table(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


# crc32 of a decimal number: its table by the rule of the polynomial, then a byte at a time.
_TABLE = "list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda r, i: xor(r // 2, 3988292384 * (r % 2))))"
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda r, s: xor(r // 256, crc.t[CAST(xor(r % 256, s) AS BIGINT) + 1])), 4294967295)"""
ORACLE["op11_conversation_trie"] = f"""WITH
  crc AS (SELECT {_TABLE} AS t),
  t AS (SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS turn, octet_length(encode(coalesce(text, ''))) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
  c AS (SELECT conv_id, n, {_CRC} % 9 AS h FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id), crc),
  l AS (SELECT c.conv_id, n, h, least(h, coalesce((SELECT b.n FROM c b WHERE b.conv_id = c.conv_id - c.conv_id % 5), 0)) AS lead FROM c),
  r AS (SELECT l.conv_id, t.pos + 1 AS d, turn, size FROM l JOIN t ON t.conv_id = l.conv_id - l.conv_id % 5 AND t.pos < l.lead
    UNION ALL SELECT l.conv_id, l.lead + t.pos - l.h + 1, turn, size FROM l JOIN t ON t.conv_id = l.conv_id AND t.pos >= l.h),
  w AS (SELECT l.conv_id, coalesce(turns, []) AS turns, coalesce(sizes, []) AS sizes FROM l LEFT JOIN
    (SELECT conv_id, list(turn ORDER BY d) AS turns, list(size ORDER BY d) AS sizes FROM r GROUP BY conv_id) USING (conv_id)),
  p AS (SELECT conv_id, d, sha256(CAST(turns[:d] AS VARCHAR)) AS k, CASE WHEN d > 0 THEN sha256(CAST(turns[:d - 1] AS VARCHAR)) END AS up,
    CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(turns) AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM w)),
  n AS (SELECT k, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends FROM p GROUP BY k, d),
  m AS (SELECT n.*, coalesce(children, 0) AS children FROM n LEFT JOIN (SELECT up AS k, d - 1 AS d, count(*) AS children FROM n GROUP BY up, d) USING (k, d)),
  s AS (SELECT p.k, p.d, sum(CASE WHEN m.children = 0 THEN 1 ELSE 0 END) AS leaves, sum((m.n - 1) * m.size) AS saved
    FROM m JOIN p ON p.conv_id = m.conv_id AND p.d <= m.d GROUP BY p.k, p.d)
SELECT m.conv_id, m.d AS depth, u.conv_id AS parent_conv_id, m.n AS n_convs, m.children AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN s USING (k, d) LEFT JOIN n u ON u.k = m.up AND u.d = m.d - 1"""


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read_table(spark, sf_dir, "documents"))


_P = "CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce({n}, 0) + 1)) // ({total} + v) AS BIGINT)"
ORACLE["op12_divergence"] = f"""WITH
  d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
  w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
  k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
  c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
  l AS (SELECT lang, coalesce(v, 0) AS v, coalesce(t, 0) AS t FROM (SELECT DISTINCT lang FROM d)
    LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS t FROM k GROUP BY lang) USING (lang)),
  g AS (SELECT lang, source, coalesce(t, 0) AS t FROM (SELECT DISTINCT lang, source FROM d)
    LEFT JOIN (SELECT lang, source, sum(n) AS t FROM c GROUP BY lang, source) USING (lang, source)),
  p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_P.format(n="c.n", total="g.t")} AS p, {_P.format(n="k.n", total="l.t")} AS q
    FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)),
  x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
  terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""


@query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality(docs, read_table(spark, sf_dir, "labels"), metadata=tuple(c for c in ("n_chars",) if c in docs.columns))
