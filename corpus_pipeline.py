"""Corpus preparation in five stages, each a table for the next one.

All stages but the last return the columns of their input, in order, whatever their names; columns
that an operator would add under the same name keep the input's values. An empty table passes through
every stage as an empty table. Null and empty texts go with the language stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import decontaminate, language, minhash, packing, queries, suffix
from pagemill.llm.staging import Staging, table


def _apart(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame, Column | None], DataFrame]]:
    """``docs`` with all columns but id and text under names that no operator uses, and the way back.

    The way back counts the characters anew (``n_chars``) where its second argument holds.
    """
    name = {c: c if c in ("doc_id", "text") else f"_own_{i}" for i, c in enumerate(docs.columns)}

    def back(df: DataFrame, changed: Column | None = None) -> DataFrame:
        out = {c: F.col(n).alias(c) for c, n in name.items()}
        if changed is not None and "n_chars" in name:
            counted = F.length("text").cast(docs.schema["n_chars"].dataType)
            out["n_chars"] = F.when(changed, counted).otherwise(F.col(name["n_chars"])).alias("n_chars")
        return df.select(*out.values())

    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in name.items()]), back


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter (null and empty texts are such); where no language could be learned, all pass.

    A null language is not learned from and rejects nothing. Repeated rows and null ids pass like others.
    """
    model = language.train(docs, ~language.held_out())
    if not model.langs:
        return docs
    apart, back = _apart(docs)
    return back(language.identify(spark, apart, model).where(F.col("lang_pred") != language.UNKNOWN))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of documents alike in their five-word shingles the one with the smallest id.

    Of several rows of one id the one with the least text stays; each row without an id stays.
    Texts without a word are alike to nothing and stay.
    """
    again = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not again.isEmpty():
        several = docs.join(again, "doc_id", "left_semi")
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        one = several.groupBy("doc_id").agg(F.min_by(row, F.struct(F.col("text"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))).alias("row"))
        docs = docs.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(one.select("row.*"))
    gone = minhash.near_duplicates(spark, docs).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document has; a document of which nothing is left goes.

    Rows without an id come after all others; null and empty texts stay as they are.
    """
    apart, back = _apart(docs)
    cut = suffix.deduplicate(spark, apart).where("n_removed = 0 OR n_removed < n_bytes")
    changed = F.col("n_removed") > 0
    return back(cut.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text"))), changed)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold benchmark windows in a twentieth of their words or more; from the others it cuts the windows.

    Texts without a word stay as they are, and so does everything where no benchmark item has a word.
    """
    apart, back = _apart(docs)
    found = decontaminate.contamination(spark, apart, table(spark, sf_dir, "benchmark"), cut=True).where("NOT contaminated")
    return back(found, F.col("n_hit") > 0)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training sequences; an empty text is its end mark alone."""
    return packing.packed(spark, docs, queries.vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", clean_of_benchmarks),
    ("packing", sequences),
]

#: The stages learn, hash and tokenise; SQL can express none of them whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Staging(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, apply) in enumerate(STAGES):
        docs = stage.write(apply(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            stage.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
