"""Registered queries of this subpackage over the given tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventwin.session import shared_dir
from llm import ann, chat, collocations, licenses, mixing, packing, prefix_trie, quality, sharding, simhash, token_store, topk, vector_dedup
from llm.exprs import LOWER, UPPER


def findable(spark: SparkSession) -> None:
    """Python workers find this repository from whatever folder the driver was started in; a cluster gets it by --py-files."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    findable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token-id files and read back."""
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_store.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_store.read_token_files(spark, path, keep_ids=False)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id bigint, turn bigint, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_conversations(given.unionByName(extra)))


def op4_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 40)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to target weights of their sources."""
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and groups of near-duplicates of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every 50th vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale_floor=256)


def op8_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every 100th vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in all documents; scores to nine digits."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).withColumn("score", F.round("score", 9))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language, over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all vectors, at a cosine of 0.9."""
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_best_fit_packing, op3_chat_formatting, op4_jump_sharding, op5_source_mix, op6_simhash_dedup, op7_exact_top_k,
    op8_quality_ranking, op9_nearest_neighbours, op10_license_scan, op11_prefix_trie, op12_phrase_mining, op13_embedding_dedup)}

_ESCAPED = "replace({0}, '\\', '\\\\')"
for _control in chat.CONTROLS:
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '{_control[0]}\\{_control[1:]}')"



def _license_sql() -> str:
    """All starts of all templates by plain joins on word and place."""
    every = [*licenses.PHRASES, *licenses.TEMPLATES]
    heads = ", ".join(f"({n}, '{t.label}', {str(t.base).lower()})" for n, t in enumerate(every))
    places = []
    for n, t in enumerate(every):
        words = t.text.split()
        keys = {i for key in t.keys for at in [f" {t.text} ".index(f" {key} ")] for first in [t.text[:at].count(" ")]
                for i in range(first, first + len(key.split()))}
        places += [f"({n}, {i}, '{w}', {str(i in keys).lower()})" for i, w in enumerate(words)]
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{licenses.WORDS}') AS ws FROM documents),
t AS (SELECT * FROM (VALUES {heads}) AS x(template, label, base)),
p AS (SELECT * FROM (VALUES {", ".join(places)}) AS x(template, pos, word, is_key)),
w AS (SELECT * FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM d) WHERE word IN (SELECT word FROM p)),
f AS (SELECT word, count(DISTINCT doc_id) AS df FROM w GROUP BY word),
v AS (SELECT p.*, ln((n + 1) / (coalesce(df, 0) + 1)) + 1e-9 AS weight FROM p LEFT JOIN f USING (word), (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents)),
s AS (SELECT template, sum(weight) AS total, count(*) FILTER (is_key) AS n_keys FROM v GROUP BY template),
m AS (SELECT doc_id, template, i - pos AS start, sum(weight) AS held, count(*) FILTER (is_key) AS k FROM w JOIN v USING (word) GROUP BY ALL),
o AS (SELECT doc_id, label, base, start, least(held / total, 1) AS score FROM m JOIN s USING (template) JOIN t USING (template) WHERE k = n_keys)
SELECT doc_id, CAST(len(any_value(ws)) AS BIGINT) AS n_words, count(start) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
max(start) FILTER (base) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(round(max(score), 9), 0) AS score
FROM d LEFT JOIN o USING (doc_id) GROUP BY doc_id"""


ORACLES = {
    # the CRC-32 of the decimal id is worked out bit by bit
    "op11_prefix_trie": r"""WITH RECURSIVE own AS (SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
bits AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM own
UNION ALL SELECT conv_id, s, i + 1, CASE WHEN w & 1 = 1 THEN xor(w >> 1, CAST(3988292384 AS BIGINT)) ELSE w >> 1 END
FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(v, CAST(ord(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE v END AS w FROM bits WHERE i < 8 * length(s))),
h AS (SELECT conv_id, xor(v, CAST(4294967295 AS BIGINT)) % 4 AS h FROM bits WHERE i = 8 * length(s)),
rebuilt AS (SELECT o.conv_id, list_concat(coalesce(b.ts[1:h], []), o.ts[h + 1:]) AS ts FROM own o JOIN h USING (conv_id)
LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (SELECT conv_id, d, ts[1:d] AS p, len(ts) = d AS ends FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM prefixes GROUP BY p, d),
children AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
figures AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.p[n.d].text, '[^\x20\x09-\x0D]+')) END AS saved FROM nodes n LEFT JOIN children c ON n.p = c.p AND n.d = c.d),
below AS (SELECT p[1:a] AS p, a AS d, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
FROM (SELECT *, unnest(range(d + 1)) AS a FROM figures) GROUP BY ALL)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves, b.saved_tokens, f.ends_sha256
FROM figures f JOIN below b ON f.p = b.p AND f.d = b.d LEFT JOIN nodes q ON q.d = f.d - 1 AND q.p = f.p[1:f.d - 1]""",
    "op12_phrase_mining": f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM ws GROUP BY lang),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: list_aggregate(ws[i:i + k - 1], 'string_agg', ' '))) AS phrase
FROM ws, (VALUES (1), (2), (3)) AS ks(k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10),
cand AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.phrase, c.k, c.a, x.a AS l, y.a AS r, cut, CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.a AS HUGEINT) * y.a) AS score
FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
JOIN f x ON x.lang = c.lang AND x.phrase = list_aggregate(c.ws[1:cut], 'string_agg', ' ')
JOIN f y ON y.lang = c.lang AND y.phrase = list_aggregate(c.ws[cut + 1:], 'string_agg', ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (SELECT lang, list_aggregate(ws[i:i + 1], 'string_agg', ' ') AS phrase, max(a) AS longer
FROM (SELECT *, unnest([1, 2]) AS i FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (SELECT o.* FROM lowest o LEFT JOIN inner_parts i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
    "op13_embedding_dedup": """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)
AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least l ON l.a = vec_id LEFT JOIN counts c ON c.a = vec_id""",
    "op10_license_scan": _license_sql(),
    # marks: 9 and 8 characters before a block's first text, 8 before each other text, 8 after the block
    "op3_chat_formatting": f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (SELECT *, coalesce(lag(role) OVER w = role, false) AS merged FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
CAST(sum(length({_ESCAPED.format("text")}) + CASE WHEN merged THEN 8 ELSE 25 + length({_ESCAPED.format("role")}) END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id""",
    "op7_exact_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
