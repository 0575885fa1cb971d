"""One query per operator, over whole tables with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilegate.llm import (
    dedup,
    html,
    langid,
    linededup,
    maxscore,
    mixing,
    neardup,
    packing,
    quality,
    runs,
    spelling,
    tokencount,
    toxicity,
)
from profilegate.llm.tables import WORD, Work, held_out, id_text, read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line chunks that occur before it."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.without_repeated_lines(Work(spark), docs).select("doc_id", "removed_lines", "text")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after addresses and long numbers are blotted out, by edits of its tree."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.col("text")
    rows = docs.select("doc_id", tokencount.counted(text, tokencount.indexed(text), tokencount.find_edits(text, tokencount.personal_spans, "***")).alias("c"))
    return rows.select(
        "doc_id",
        F.size("c.tree.chars").alias("segments"),
        F.col("c.before").alias("tokens_before"),
        F.col("c.edits").alias("edits"),
        F.col("c.encoded_chars").alias("encoded_chars"),
        F.col("c.after").alias("tokens_after"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four fifths of the labelled ones."""
    work, docs, labels = Work(spark), read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    out_of_fold = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(work, docs, labels.filter(~out_of_fold))
    out = docs.select("doc_id", out_of_fold.alias("held_out"), toxicity.toxicity(work, model, F.col("text")).alias("t"))
    score = F.col("t.score")
    return out.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every fiftieth one, among all."""
    work = Work(spark)
    usable = maxscore.quantised(read(spark, sf_dir, "embeddings"), most=None)
    vectors = work.land(usable.withColumn("row", F.monotonically_increasing_id()), "vectors")
    return maxscore.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5, "row")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document adds to the mix, with its source's size and target."""
    out = mixing.mix_sizes(Work(spark), read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 80 % of four-word shingles."""
    return neardup.near_duplicates(Work(spark), read(spark, sf_dir, "documents"), words=4)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages")
    out = pages.select("page_id", "url", html.extract(F.col("html")).alias("main"))
    return out.select("page_id", "url", "main.text", F.length("main.text").cast("long").alias("n_chars"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 2048 tokens."""
    return packing.pack_documents(Work(spark), read(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that stays for each one, among those whose texts are equal without white space."""
    out = dedup.exact_duplicates(Work(spark), read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumnRenamed("digest", "text_sha256")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of those with a label."""
    work, docs = Work(spark), read(spark, sf_dir, "documents")
    out_of_fold = held_out(F.col("doc_id"), 3, 1)
    model = langid.fit(work, docs.filter(~out_of_fold))
    out = docs.select("doc_id", out_of_fold.alias("held_out"), langid.label(work, model, F.col("text")).alias("language"))
    return out.select("doc_id", "held_out", "language.lang_pred", "language.score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with their near words, form and root; a letter is taken from one in 97 of the documents' words."""
    work, docs = Work(spark), read(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(work, spelling.word_counts(docs, spelling.thinned))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements of every document, the rules it fails, and whether the current policy keeps it."""
    rows = quality.ledger(read(spark, sf_dir, "documents").select("doc_id", "text"))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select(
        "doc_id",
        *measures,
        quality.failed(quality.BASE).alias("base_failed"),
        (~quality.failed(quality.POLICIES[quality.CURRENT])).alias("kept"),
        quality.FAILED,
    )


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text, of which one in ten by the hash of its id goes round a loop of its words from some word on."""
    known = F.crc32(id_text(F.col("doc_id")).cast("binary"))
    rest = ((known - known % 10) / 10).cast("long")
    words = F.when(known % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    rows = docs.select("doc_id", "text", rest.alias("rest"), words.alias("w")).withColumn("n", F.size("w"))
    rows = rows.withColumn("first", F.when(F.col("n") > 0, F.col("rest") % F.col("n")).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("first")) / (3 + F.col("rest") % 8))
    rows = rows.withColumn("period", period.cast("int"))
    loop = F.transform(
        F.sequence(F.col("first"), F.col("n") - 1),
        lambda i: F.col("w")[F.col("first") + (i - F.col("first")) % F.col("period")],
    )
    text = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("first")), loop)
    return rows.select("doc_id", F.when(F.col("first").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs of every document, the longest of them, and digests of all runs and of the text without repeats."""
    Work(spark)
    docs = looped(read(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = docs.select("doc_id", runs.periodic_runs(F.col("text")).alias("r"))
    run = F.arrays_zip("r.start", "r.length", "r.period")
    rows = rows.select("doc_id", F.col("r.collapsed").alias("collapsed"), run.alias("runs"))
    longest = F.array_min(F.transform("runs", lambda x: F.struct((-x["length"]).alias("less"), x["start"], x["period"])))
    line = lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))
    rows = rows.select("doc_id", "runs", longest.alias("longest"), "collapsed")
    length, period = -F.col("longest.less"), F.col("longest.period")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        ((1000 * length - 1000 * length % period) / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_exact_topk": op4_exact_topk,
    "op5_source_mixing": op5_source_mixing,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_quality_rules": op12_quality_rules,
    "op13_periodic_runs": op13_periodic_runs,
}


def statements() -> dict[str, str]:
    return {
        "op1_line_dedup": linededup.ORACLE_SQL,
        "op4_exact_topk": maxscore.ORACLE_SQL,
        "op5_source_mixing": mixing.oracle(),
        "op9_exact_dedup": dedup.ORACLE_SQL,
        "op12_quality_rules": quality.ORACLE_SQL,
    }
