"""The operators of this subpackage over the given tables.

Documents stand in for posts: doc_id is the post's id, text its caption, source its tag. Pages stand in for raw
responses and for links.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import (
    collocations, conversations, embeddings, line_quality, mixing, packing, sentencepiece_codec, sharding, simhash, substrings, toxicity, url_rules, warc,
)
from postlake.session import configure, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def posts_of(documents: DataFrame) -> DataFrame:
    return documents.selectExpr("doc_id AS id", "text AS caption", "source AS hashtag_id")


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LINKS_SQL = """
WITH RECURSIVE unit AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (SELECT a.vec_id AS src, b.vec_id AS dst FROM unit AS a JOIN unit AS b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.dst FROM reach AS r JOIN links AS l ON l.src = r.other),
lowest AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1), counts AS (SELECT src, count(*) AS n FROM links GROUP BY 1)
SELECT w.vec_id, coalesce(n, 0) AS n_links, component_id, w.vec_id = component_id AS kept FROM lowest AS w LEFT JOIN counts ON src = w.vec_id"""

PAYLOAD_SQL = """
WITH sized AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS bytes, sha1(encode(coalesce(html, ''))) AS digest FROM pages),
chosen AS (SELECT digest AS d, max(page_id) AS response FROM sized WHERE bytes >= 1000 GROUP BY 1)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN coalesce(response, page_id) = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to FROM sized LEFT JOIN chosen ON d = digest AND bytes >= 1000"""

REPEATS_SQL = f"""
WITH texts AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (SELECT doc_id, s, words[s:s + 19] AS w FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS s FROM texts WHERE len(words) >= 20)),
firsts AS (SELECT w, min((doc_id, s)) AS f FROM windows GROUP BY 1),
gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(generate_series(s, s + 19)) AS k FROM windows JOIN firsts USING (w) WHERE (doc_id, s) <> f) GROUP BY 1),
kept AS (SELECT t.doc_id, len(words) AS n, CASE WHEN ks IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(ks, i)) END AS left_words FROM texts AS t LEFT JOIN gone AS g ON g.doc_id = t.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(left_words) AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(left_words, ' '), '')) AS kept_sha256 FROM kept"""


def _rules_sql() -> str:
    """Host rules read literally, the other patterns as regular expressions."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    hosts = ", ".join(f"({quoted(r.verdict)}, {quoted(r.pattern[2:].split('/')[0])}, {quoted('/' + r.pattern.split('/', 1)[1])})" for r in url_rules.HOST_RULES)
    others = ", ".join(f"({quoted(r.verdict)}, {quoted(url_rules._regex(r.pattern).pattern.replace(chr(92) + 'Z', chr(92) + 'z'))}, {len(r.pattern)})" for r in url_rules.PATTERN_RULES)
    return f"""
WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS h, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail FROM (SELECT page_id, coalesce(rest, '') AS rest FROM rest)),
parts AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(tail, '^([^?]*)', 1) AS path, tail FROM cut),
hosts AS (SELECT * FROM (VALUES {hosts}) AS t(verdict, h, p)), others AS (SELECT * FROM (VALUES {others}) AS t(verdict, regex, size)),
ruled AS (SELECT page_id, arg_max(h || p, len(h || p)) AS rule, arg_max(verdict, len(h || p)) AS verdict FROM parts JOIN hosts ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1),
fitted AS (SELECT page_id, arg_max(verdict, 2 * size + CAST(verdict = 'block' AS INT)) AS verdict FROM parts JOIN others ON regexp_matches(host || tail, regex) GROUP BY 1)
SELECT p.page_id, host, path, rule, coalesce(r.verdict, f.verdict, 'allow') AS verdict FROM parts AS p LEFT JOIN ruled AS r ON r.page_id = p.page_id LEFT JOIN fitted AS f ON f.page_id = p.page_id"""

PHRASES_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
cut AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
placed AS (SELECT lang, p, unnest(generate_series(1, len(words))) AS i, unnest(words) AS w1 FROM cut),
runs AS (SELECT lang, w1, lead(w1, 1) OVER near AS w2, lead(w1, 2) OVER near AS w3 FROM placed WINDOW near AS (PARTITION BY p ORDER BY i)),
totals AS (SELECT lang, count(*) AS n FROM runs GROUP BY 1),
f1 AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL), f2 AS (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
inner_pairs AS (SELECT lang, w1, w2, max(f) AS longer FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
two AS (SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r, 1 AS k FROM f2 JOIN f1 AS x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 AS y ON y.lang = f2.lang AND y.w1 = f2.w2
  LEFT JOIN inner_pairs AS q ON q.lang = f2.lang AND q.w1 = f2.w1 AND q.w2 = f2.w2 WHERE f2.f >= 10 AND (longer IS NULL OR 100 * longer < 50 * f2.f)),
three AS (SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x.f AS l, y.f AS r, 1 AS k FROM f3 AS t JOIN f1 AS x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f2 AS y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 2 FROM f3 AS t JOIN f2 AS x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN f1 AS y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (SELECT lang, phrase, a, l, r, k, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM (SELECT * FROM two UNION ALL SELECT * FROM three)),
chosen AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM chosen) JOIN totals USING (lang) WHERE rank <= 2000"""


@query("op1_embedding_near_dedup", LINKS_SQL)
def _(spark, sf_dir):
    return embeddings.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op2_warc_zstd", PAYLOAD_SQL)
def _(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    raw = pages.selectExpr("page_id AS id", "url AS permalink", "html AS payload", "CAST(NULL AS TIMESTAMP) AS fetched_at")
    archives = staged(warc.write_archives(raw, "text/html; charset=utf-8"), "archives")
    records = warc.read_archives(archives, "long")
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("archive record "), "error")).cast("long")).otherwise(F.col("id"))
    return records.select(sound.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


# The public 32k vocabulary of the box; any SentencePiece model file will do.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


@query("op3_sentencepiece")
def _(spark, sf_dir):
    vocabulary = sentencepiece_codec.read_vocabulary(TOKENIZER)
    decoded = sentencepiece_codec.round_trip(_posts(spark, sf_dir), vocabulary)
    return decoded.select(F.col("id").alias("doc_id"), "n_pieces", "pieces", F.sha2("caption", 256).alias("decoded_sha256"))


@query("op4_simhash_near_dedup")
def _(spark, sf_dir):
    found = simhash.simhash_duplicates(_posts(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "kept")


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id AS id", "toxic")


@query("op5_toxicity")
def _(spark, sf_dir):
    posts = _posts(spark, sf_dir)
    scored = toxicity.score_toxicity(posts, toxicity.train_toxicity(posts, labels_of(spark, sf_dir)))
    return scored.withColumnRenamed("id", "doc_id")


@query("op6_substring_dedup", REPEATS_SQL)
def _(spark, sf_dir):
    cut = substrings.remove_repeats(_posts(spark, sf_dir))
    return cut.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_caption", 256).alias("kept_sha256"))


@query("op7_mixing")
def _(spark, sf_dir):
    taken = mixing.taken_per_post(mixing.mix_posts(_posts(spark, sf_dir)))
    return taken.select(F.col("id").alias("doc_id"), F.col("hashtag_id").alias("source"), "size", "source_size", "target", "taken")


@query("op8_line_quality")
def _(spark, sf_dir):
    posts = _posts(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id AS id", "quality")
    return line_quality.judge_captions(posts, line_quality.train_field(posts, labels)).withColumnRenamed("id", "doc_id")


@query("op9_two_pass_shuffle")
def _(spark, sf_dir):
    written = sharding.shard_posts(_posts(spark, sf_dir))
    return written.select(
        F.col("post.id").alias("doc_id"), "size", F.crc32(F.coalesce("post.caption", F.lit(""))).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"), "shard", "slot", "grown_shard",
    )


@query("op10_url_rules", _rules_sql())
def _(spark, sf_dir):
    links = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id AS id", "url AS permalink")
    return url_rules.judge_links(links).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of conversations with faults put in by a hash of their place: ``lost`` marks those that drop out."""
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    marked = turns.select("conv_id", "turn", "role", "text", (F.crc32(place) % 20).alias("mark"))
    return marked.select(
        F.col("conv_id").alias("conversation_id"), "turn", F.when(F.col("mark") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("mark") == 1, "").when(F.col("mark") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("mark") == 0).alias("lost"), F.explode(F.when(F.col("mark") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


@query("op11_conversation_repair")
def _(spark, sf_dir):
    turns = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversations.repair_conversations(turns, F.col("lost")).withColumnRenamed("conversation_id", "conv_id")


# The public byte-level vocabulary of the box; any tokenizer file of that kind will do.
BYTE_TOKENIZER = "byte_bpe_50k.json"


@query("op12_best_fit_packing")
def _(spark, sf_dir):
    model = Path(public_tokenizers.path(BYTE_TOKENIZER)).read_text(encoding="utf-8")
    packed = packing.pack_captions(_posts(spark, sf_dir), model)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


@query("op13_collocations", PHRASES_SQL)
def _(spark, sf_dir):
    # A language takes the part of a tag here.
    posts = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS id", "text AS caption", "lang AS hashtag_id")
    return collocations.caption_collocations(posts).withColumnRenamed("hashtag_id", "lang")
