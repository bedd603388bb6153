"""The registered queries of the corpus operators and their SQL (``opN_<name>``, ``pipeline``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import bpe, chat, decontaminate, exact_dedup, html_wrapper, minhash, pii, quality, repeats, secrets, url_rules, whitening, zfast
from emporia.llm.common import read

TOKENIZER = "byte_bpe_50k.json"
Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan_documents(read(spark, sf, "documents", "doc_id", "text"))


def op2_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove(read(spark, sf, "documents", "doc_id", "text"))


def op3_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    got = exact_dedup.classes(read(spark, sf, "documents", "doc_id", "text"))
    return got.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("hex").alias("text_sha256"))


def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    got = decontaminate.scan(read(spark, sf, "documents", "doc_id", "text"), read(spark, sf, "benchmark", "item_id", "text"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_minhash(spark: SparkSession, sf: str) -> DataFrame:
    got = minhash.classes(read(spark, sf, "documents", "doc_id", "text"))
    return got.select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def op6_html(spark: SparkSession, sf: str) -> DataFrame:
    return html_wrapper.extract(read(spark, sf, "pages", "page_id", "url", "html"))


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.scored(read(spark, sf, "documents", "doc_id", "text"), read(spark, sf, "labels", "doc_id", "quality"))


def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    got = pii.detect(read(spark, sf, "documents", "doc_id", "text"))
    return got.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_chat(spark: SparkSession, sf: str) -> DataFrame:
    turns = read(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_segments(chat.format_segments(turns.unionByName(extra)))


def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digest_documents(read(spark, sf, "documents", "doc_id", "text"), tokenizer_path())


def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitened(read(spark, sf, "embeddings", "vec_id", "embedding"))


def op12_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    return url_rules.judged(read(spark, sf, "pages", "page_id", "url"))


def op13_zfast_trie(spark: SparkSession, sf: str) -> DataFrame:
    return zfast.trie(zfast.rebuilt(zfast.turn_digests(read(spark, sf, "conversations", "conv_id", "turn", "role", "text"))))


def registry() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_secrets, op2_repeats, op3_exact_dedup, op4_decontaminate, op5_minhash, op6_html, op7_quality, op8_pii, op9_chat,
                                    op10_bpe, op11_whitening, op12_url_rules, op13_zfast_trie)}


# ---- DuckDB SQL, where SQL expresses the whole query ----
_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

ORACLE = {
    "op3_exact_dedup": f"""
WITH t AS (SELECT doc_id, {_NORMAL} AS n FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(n) AS text_sha256
FROM t WINDOW w AS (PARTITION BY n)""",
    "op4_decontaminate": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS g
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(array_to_string(list_sort(list_distinct(list(item))), ',')) AS s FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    # Every combination of a URL's tokens is counted; the best one that passes both bounds decides.
    "op12_url_rules": r"""
WITH a AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS rid FROM a),
c AS (SELECT *, CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                     WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
                     WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/' WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
                     WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule, string_split(host, '.') AS l FROM b),
t AS (SELECT rid, page_id, host, path, rule, CASE rule WHEN 'org/' THEN 'allow' WHEN 'com/fr/' THEN 'allow' ELSE CASE WHEN rule IS NOT NULL THEN 'block' END END AS label,
             CASE WHEN host = '' THEN [] ELSE list_filter([
               CASE WHEN l[-1] <> '' THEN 'tld:' || l[-1] END, CASE WHEN len(l) > 1 THEN 'site:' || l[-2] || '.' || l[-1] END,
               CASE WHEN len(l) > 2 AND l[1] <> '' THEN 'sub:' || l[1] END,
               CASE WHEN regexp_extract(path, '^/+([^/]+)/', 1) <> '' THEN 'dir:' || regexp_extract(path, '^/+([^/]+)/', 1) END,
               CASE WHEN path <> '' THEN 'shape:' || regexp_replace(path, '[0-9]+', '0', 'g') END,
               CASE WHEN regexp_extract(path, '\.([A-Za-z0-9]+)$', 1) <> '' THEN 'ext:' || regexp_extract(path, '\.([A-Za-z0-9]+)$', 1) END,
               CASE WHEN regexp_replace(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '=[^&]*', '', 'g') <> ''
                    THEN 'keys:' || regexp_replace(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '=[^&]*', '', 'g') END,
               CASE WHEN strpos(url, '#') > 0 THEN 'fragment:#' END], lambda x: x IS NOT NULL) END AS items FROM c),
e AS (SELECT rid, label, list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS s
      FROM (SELECT rid, label, items, unnest(range(1, CAST(pow(2, len(items)) AS BIGINT))) AS m FROM t)),
f AS (SELECT s, count(*) AS n, count(*) FILTER (WHERE label = 'allow') AS na, count(*) FILTER (WHERE label = 'block') AS nb FROM e WHERE label IS NOT NULL GROUP BY s),
r AS (SELECT s, n, unnest(['allow', 'block']) AS said, unnest([na, nb]) AS k FROM f),
kept AS (SELECT s, said, k, CAST(k AS DOUBLE) / n AS conf FROM r
         WHERE k > 0 AND k >= ceil(CAST(0.01 AS DOUBLE) * (SELECT count(*) FROM t WHERE label IS NOT NULL)) AND CAST(k AS DOUBLE) / n >= CAST(0.9 AS DOUBLE)),
best AS (SELECT rid, first(said ORDER BY conf DESC, k DESC, len(s), said) AS said FROM e JOIN kept USING (s) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(label, said, 'allow') AS verdict FROM t LEFT JOIN best USING (rid)""",
    # Every prefix of every rebuilt conversation is a row; the CRC is worked out bit by bit.
    "op13_zfast_trie": r"""
WITH bits AS (SELECT DISTINCT conv_id, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS s
              FROM conversations WHERE conv_id IS NOT NULL),
head AS (SELECT conv_id, xor(list_reduce(list_concat([4294967295], s), lambda acc, c: list_reduce(list_concat([xor(acc, c)], [0, 0, 0, 0, 0, 0, 0, 0]),
              lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 9 AS h FROM bits),
t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'d': substr(sha256(strlen(r) || ':' || r || x), 1, 32), 'n': strlen(x)}
              ORDER BY turn NULLS FIRST, substr(sha256(strlen(r) || ':' || r || x), 1, 32)) AS s FROM t GROUP BY conv_id),
re AS (SELECT o.conv_id, list_concat(coalesce(b.s, [])[1:h], o.s[h + 1:]) AS s
       FROM own o JOIN head USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
pre AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM re),
k AS (SELECT conv_id, d, len(s) AS m, list_reduce(list_concat([''], list_transform(s[1:d], lambda y: y.d)), lambda a, b: sha256(a || b)) AS id,
             CASE WHEN d > 0 THEN list_reduce(list_concat([''], list_transform(s[1:d - 1], lambda y: y.d)), lambda a, b: sha256(a || b)) END AS up,
             CASE WHEN d > 0 THEN s[d].n ELSE 0 END AS n FROM pre),
g AS (SELECT id, d, any_value(up) AS up, min(conv_id) AS conv, count(*) AS members, any_value(n) AS n,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE m = d), '')) AS ends FROM k GROUP BY id, d),
kids AS (SELECT up, count(*) AS c FROM g WHERE up IS NOT NULL GROUP BY up),
pairs AS (SELECT DISTINCT a.id AS top, b.id AS node, b.d FROM k a JOIN k b ON a.conv_id = b.conv_id AND a.d <= b.d),
sub AS (SELECT top, sum((members - 1) * n) AS saved, count(*) FILTER (WHERE c IS NULL) AS leaves
        FROM pairs JOIN g ON g.id = node AND g.d = pairs.d LEFT JOIN kids ON kids.up = node GROUP BY top)
SELECT g.conv AS conv_id, CAST(g.d AS BIGINT) AS depth, p.conv AS parent_conv_id, g.members AS n_convs, coalesce(c, 0) AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, g.ends AS ends_sha256
FROM g JOIN sub ON sub.top = g.id LEFT JOIN kids ON kids.up = g.id LEFT JOIN g p ON p.id = g.up""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
