"""From raw documents to a token file: five stages, each written as Parquet and read again by the next.

Every stage takes all that its predecessor kept and, but for the last, returns the columns of ``documents``, with any
others that came with them. Stages decide on rows: what they judge is the text (and, where that matters, id and source)
of a row, so rows without an id and rows that repeat an id need no special care. Columns that stages add for their own
use get names that no given column has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerframe.llm import decontaminate, jaccard_join, mixing, quality_rules, token_file
from ledgerframe.llm.native import words
from ledgerframe.llm.queries import byte_bpe, table
from ledgerframe.llm.store import Scratch, temporary, writing


def _free(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text neither the base nor a learned rule rejects.

    Null and blank texts have no words and go. Rows are judged one by one, so rows that repeat, with or without an id,
    stay or go by their text. An empty table, or one without labels, is judged by the base alone.
    """
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    stats = quality_rules.statistics(docs.select(F.struct(*docs.columns).alias("row")), "row.text", ("row",))
    return quality_rules.verdicts(stats, rules).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest doc_id.

    Rows count, not ids: of rows that repeat an id or have none one stays as well, unless their texts differ. A null id
    comes after all others. Texts without words are near nothing, so all rows with such a text stay.
    """
    row = _free(docs, "row")
    docs = Scratch(spark, "numbered").keep(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = jaccard_join.jaccard_components(docs.select(row, "text"), key=row).select(F.col("doc_id").alias("_row"), "component_id")
    ids = docs.select(F.col(row).alias("_row"), F.col("doc_id").alias("_id"))
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "_row"))["_row"]
    kept = groups.join(ids, "_row").groupBy("component_id").agg(first.alias("_kept")).select(F.col("_kept").alias(row))
    return docs.join(kept, row, "left_semi").drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no passage of the benchmark.

    The text decides, by its digest, so rows without an id are cleaned as well, and rows that repeat share their fate.
    Null and empty texts hold nothing and stay; with an empty benchmark all rows stay.
    """
    digest = _free(docs, "digest")
    marked = docs.withColumn(digest, F.md5("text"))
    texts = marked.select(F.col(digest).alias("digest"), "text")
    leaks = decontaminate.overlaps(texts, table(spark, sf_dir, "benchmark"), key="digest").select(F.col("digest").alias(digest)).distinct()
    return marked.join(leaks, digest, "left_anti").drop(digest)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, up to three times.

    The copies depend on id, source and text, and rows find theirs by these (a null equals a null), so rows that repeat
    an id don't multiply each other. Texts without words have no size and are never taken.
    """
    copies = mixing.mix(docs).where("copies > 0").select("doc_id", "source", "size", "print", "copies").distinct()
    names = {c: _free(docs, f"mix_{c}") for c in ("doc_id", "source", "size", "print", "copies")}
    copies = copies.withColumnsRenamed(names)
    same = F.lit(True)
    for name, own in {"doc_id": F.col("doc_id"), "source": F.col("source"), "size": F.size(words(F.col("text"))).cast("long"), "print": F.md5("text")}.items():
        same = same & F.col(names[name]).eqNullSafe(own)
    each = F.explode(F.sequence(F.lit(1), F.col(names["copies"]).cast("int"))).alias(_free(docs, "copy"))
    return docs.join(copies, same).select(*docs.columns, each).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file of the mix, and what it holds of each row: (doc_id, start, n_tokens, ids_crc32).

    Every row is written; those without an id come first, rows that repeat an id follow one another, and a null text
    has the end id alone.
    """
    path = Scratch(spark, "pipeline-tokens").path("file")
    token_file.write_tokens(docs, path, byte_bpe())
    return token_file.read_documents(spark, path)


STAGES = [
    ("quality rules", quality),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixture),
    ("token output", tokens),
]

#: The learned rules and the tokenizer can't be written in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's input and its operators' tables go when its output is written; the
    token file and the last stage's rows stay."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with temporary():
            out = stage(spark, docs, sf_dir)
            with writing(spark):
                out.write.mode("overwrite").parquet(scratch.path(f"stage-{k}"))
        scratch.drop(*[f"stage-{k - 1}"] * (k > 0))
        docs = spark.read.schema(out.schema).parquet(scratch.path(f"stage-{k}"))
    out = scratch.keep(STAGES[-1][1](spark, docs, sf_dir), f"stage-{len(STAGES) - 1}")
    scratch.drop(f"stage-{len(STAGES) - 2}")
    return out
