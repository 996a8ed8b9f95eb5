"""From collected documents to training pieces, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of documents,
the last one pieces. Stages are written as Parquet and read again, so each starts from stored rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm import mixing, sentencepiece_codec, simhash, substrings, toxicity
from postlake.llm.queries import TOKENIZER, labels_of, posts_of
from postlake.session import configure, staged


# Rows of an Arrow batch. Whole documents are sent to workers, some columns twice; Spark's default of 10,000 rows would be tens of MB
# a batch, which an executor's buffers and workers keep for the stages after.
BATCH_ROWS = 1_000


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage with the session's options set, and Arrow batches of BATCH_ROWS. They hold when its result is written, so they stay set."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that the classifier calls toxic. Rows without id are scored too, and kept if clean."""
    posts = posts_of(docs)
    model = toxicity.train_toxicity(posts, labels_of(spark, sf_dir))
    # Scored with the whole row for an id, so no row is lost or doubled by a join on ids.
    scored = toxicity.score_rows(whole(docs).select(F.col("doc").alias("id"), F.col("doc.text").alias("caption")), model)
    return scored.filter(F.col("score") < 0.5).select("id.*")


@in_small_batches
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group keep the document with the smallest id. Documents without id stay. Rows that repeat an id
    and its text become one; rows that share an id only are documents of their own, told apart by a hash of the text."""
    own = F.struct("doc_id", F.xxhash64("text").alias("text_hash"))
    found = simhash.simhash_duplicates(docs.select(F.when(F.col("doc_id").isNotNull(), own).alias("id"), F.col("text").alias("caption")))
    rejected = found.filter("id is not null and not kept").select(F.col("id.doc_id").alias("rejected_id"), "id.text_hash").distinct()
    same = (F.col("doc.doc_id") == F.col("rejected_id")) & (F.xxhash64("doc.text") == F.col("text_hash"))
    return whole(docs).join(rejected, same, "left_anti").select("doc.*").dropDuplicates(["doc_id", "text"])


@in_small_batches
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that occur earlier out of the texts. A text that loses nothing stays as it is; one that loses every word goes."""
    cut = substrings.remove_repeats(posts_of(docs)).filter("n_removed > 0")
    cut = cut.select(F.col("id").alias("cut_id"), "caption_hash", "n_words", "n_removed", "kept_caption")
    cut = cut.dropDuplicates(["cut_id", "caption_hash"])
    joined = whole(docs).join(cut, (F.col("doc.doc_id") == F.col("cut_id")) & (F.xxhash64("doc.text") == F.col("caption_hash")), "left").filter("n_removed is null or n_removed < n_words")
    return with_text(joined, docs.columns, F.coalesce("kept_caption", "doc.text"))


@in_small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of each document that the mix takes, in reading order, a time through the source after the other."""
    # Mixed with the rest of its row for an id, so rows that share an id, or have none, keep their own columns.
    rest = [f for f in docs.schema.fields if f.name not in ("text", "source", "n_chars")]
    own = F.struct(*[entries_for_maps(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in rest])
    posts = docs.select(own.alias("id"), F.col("text").alias("caption"), F.col("source").alias("hashtag_id"))
    mixed = mixing.mix_posts(posts).filter("taken > 0")
    parts = F.sort_array(F.collect_list(F.struct("times", "start", "text")))
    text = F.array_join(F.transform(parts, lambda p: p["text"]), " ")
    texts = mixed.groupBy("id", "hashtag_id", "offset").agg(text.alias("mixed_text"))
    back = [maps_of_entries(F.col(f"id.`{f.name}`"), f.dataType).alias(f.name) for f in rest]
    rows = texts.select(F.struct(*back, F.col("hashtag_id").alias("source")).alias("doc"), "mixed_text")
    return with_text(rows, docs.columns, F.col("mixed_text"))


@in_small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every text, with the text that they decode to."""
    vocabulary = sentencepiece_codec.read_vocabulary(TOKENIZER)
    # Workers that earlier stages have used hold memory of theirs, so this stage remembers less.
    decoded = sentencepiece_codec.round_trip(posts_of(docs), vocabulary, remembered=1 << 16)
    return decoded.select(F.col("id").alias("doc_id"), "n_pieces", "pieces", F.col("caption").alias("text"))


def whole(docs: DataFrame) -> DataFrame:
    """Rows as one struct column ``doc``, so that no column of theirs clashes with those of a join."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def _entries(kind: T.MapType) -> T.ArrayType:
    return T.ArrayType(T.StructType().add("key", kind.keyType).add("value", kind.valueType))


def _inside(column: Column, kind: T.DataType, change) -> Column:
    """``change`` at the elements or fields of a column that hold maps; a null stays one."""
    if "map<" not in kind.simpleString():
        return column
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: change(x, kind.elementType))
    fields = [change(column[f.name], f.dataType).alias(f.name) for f in kind.fields]
    return F.when(column.isNotNull(), F.struct(*fields))


def entries_for_maps(column: Column, kind: T.DataType) -> Column:
    """Maps, at any depth, as arrays of their entries: a row with maps can be neither hashed nor grouped."""
    if isinstance(kind, T.MapType):
        column, kind = F.map_entries(column), _entries(kind)
    return _inside(column, kind, entries_for_maps)


def maps_of_entries(column: Column, kind: T.DataType) -> Column:
    """Turns back what ``entries_for_maps`` did to a column of type ``kind``."""
    if isinstance(kind, T.MapType):
        return F.map_from_entries(_inside(column, _entries(kind), maps_of_entries))
    return _inside(column, kind, maps_of_entries)


def with_text(rows: DataFrame, columns: list[str], text) -> DataFrame:
    """The columns of documents, out of ``doc``, with another text and its length."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"doc.`{c}`") for c in columns])


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# Trained scores, fingerprints and drawn slots are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
