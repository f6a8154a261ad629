"""Bindings of the three input shapes to the driver's parquet tables.

Each binding is a projection (plus one UNION ALL for postings), so Catalyst
prunes the parquet columns it does not need and pushes filters to the scan.
The same projections are written in SQL for the oracle (`plans/oracle.py`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.term_tables import vocabulary_table
from quarry.params import KMeansParams, Vocabulary
from quarry.session import local_table, scratch_folder
from quarry.sources.articles import article_line
from quarry.sources.postings import posting_line

# --- Fixed values of the bindings ------------------------------------------
# Article vocabulary, in order (the last term never occurs: zero fill).
DOC_TERMS = Vocabulary(("the", "of", "and", "to", "in", "is", "that", "de", "der",
                        "la", "le", "est", "und", "The", "zzz-none"))
# Posting tags in order (position = coordinate / spread); "4-NOT SPECIFIED"
# is left out on purpose so that some questions have an unknown tag.
POSTING_TAGS = Vocabulary(("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"))
POSTING_KMEANS = KMeansParams(spread=50000, k=12, eta=20.0, max_iter=120, seed=42)
# A fixed number of rounds for the checked fit: eta 0 never converges.
POSTING_KMEANS_FIXED = KMeansParams(spread=50000, k=12, eta=0.0, max_iter=5, seed=42)
# Fifteen tags and 45 centres, over the brands of the parts.
BRAND_TAGS = Vocabulary(tuple(f"Brand#{i}" for i in range(1, 16)))
BRAND_KMEANS = KMeansParams(spread=50000, k=45, eta=20.0, max_iter=120, seed=42)
# Centres for a search among many, by rule: on and beside the lines of the brands.
MANY_CENTRES = tuple((i % 15 * 50000 + i % 7 - 3, i * 37 % 401) for i in range(1500))
RANKED_BLOCK_DOCS = 64
ANSWER_ID_BASE = 1000000000
SCORE_OFFSET = 25
# ---------------------------------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- articles ----------------------------------------------------------------

def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`doc_id bigint, title string, text string` from `documents`."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("doc_id").cast("string").alias("title"), "text")


def article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`doc_id, value`: the article line form, built in memory (texts hold
    newlines, so they cannot round-trip through line files)."""
    a = articles(spark, sf_dir)
    return a.select("doc_id", article_line(F.col("title"), F.col("text")).alias("value"))


def term_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`term`: a large vocabulary from tables: the tokens of pages, conversations
    and benchmark passages, and a name for every line item."""
    parts = [table(spark, sf_dir, name).select(F.explode(F.split(column, " ")).alias("term"))
             for name, column in (("pages", "html"), ("conversations", "text"), ("benchmark", "text"))]
    items = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("term"))
    return vocabulary_table(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(items))


# -- postings ----------------------------------------------------------------

def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions from `orders`, answers from `lineitem`."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    null_long = F.lit(None).cast("bigint")
    questions = o.select(
        F.lit(1).alias("posting_type"),
        F.col("o_orderkey").alias("id"),
        null_long.alias("accepted_answer"),
        null_long.alias("parent_id"),
        F.lit(0).cast("bigint").alias("score"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("tags"),
    )
    answers = li.select(
        F.when(F.col("l_linenumber") == 7, F.lit(3)).otherwise(F.lit(2)).alias("posting_type"),
        (F.lit(ANSWER_ID_BASE) + F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
        null_long.alias("accepted_answer"),
        F.when(F.col("l_returnflag") == "R", null_long).otherwise(F.col("l_orderkey")).alias("parent_id"),
        (F.col("l_quantity").cast("bigint") - F.lit(SCORE_OFFSET)).alias("score"),
        F.lit(None).cast("string").alias("tags"),
    )
    return questions.unionByName(answers)


def brand_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions from `part` (the tag is the brand), answers from `lineitem`:
    an answer to its part, scored quantity x line number."""
    null_long, null_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    questions = table(spark, sf_dir, "part").select(
        F.lit(1).alias("posting_type"), F.col("p_partkey").alias("id"), null_long.alias("accepted_answer"),
        null_long.alias("parent_id"), F.lit(0).cast("bigint").alias("score"), F.col("p_brand").alias("tags"))
    answers = table(spark, sf_dir, "lineitem").select(
        F.lit(2).alias("posting_type"),
        (F.lit(ANSWER_ID_BASE) + F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
        null_long.alias("accepted_answer"), F.col("l_partkey").alias("parent_id"),
        (F.col("l_quantity").cast("bigint") * F.col("l_linenumber")).cast("bigint").alias("score"),
        null_text.alias("tags"))
    return questions.unionByName(answers)


def posting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`value`: the posting line form of `postings`, built in memory."""
    p = postings(spark, sf_dir)
    return p.select(posting_line(p).alias("value"))


# -- respondents (wide survey rows) ------------------------------------------

RESPONDENT_COLUMNS = ("tucaseid", "telfs", "tesex", "teage", "t010101", "t110101",
                      "t180301", "t050101", "t180501", "t120301", "t181201", "t500101")


def respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One survey row per `lineitem` row, integer minutes as doubles."""
    li = table(spark, sf_dir, "lineitem")
    o, p, s, n = (F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
                  F.col("l_linenumber"))
    q = F.col("l_quantity")
    exprs = {
        "tucaseid": (o * 10 + n).cast("string"),
        "telfs": n,
        "tesex": F.lit(1) + p % 2,
        "teage": q + F.lit(15),
        "t010101": (o * 7 + p) % 600,
        "t110101": (p * 11) % 120,
        "t180301": (s * 13 + o) % 90,
        "t050101": (o * 3 + n) % 480,
        "t180501": (p * 5) % 45,
        "t120301": (o + s) % 200,
        "t181201": (p + n) % 60,
        "t500101": n,
    }
    return li.select(*[
        (e if c == "tucaseid" else e.cast("double")).alias(c) for c, e in exprs.items()
    ])


def respondent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`value`: the header line, then one CSV line per respondent row."""
    r = respondents(spark, sf_dir)
    header = local_table(spark, {"value": "string"}, [(",".join(RESPONDENT_COLUMNS),)])
    body = r.select(F.concat_ws(",", *[F.col(c).cast("string") for c in RESPONDENT_COLUMNS]).alias("value"))
    return header.unionByName(body)


# -- files ---------------------------------------------------------------------
# Table rows written as line files into the shared folder, for the readers.
FILES = 8                 # at least so many files, and as many as cores
DAMAGE_CYCLE = 101        # of so many respondents, four have a bad line


def _files(spark: SparkSession) -> int:
    return max(FILES, spark.sparkContext.defaultParallelism)


def _write_csv(lines: DataFrame, header: str) -> str:
    """Lines as CSV files, each with the header. Written as one column that is
    named by the whole header, so nothing is quoted or escaped."""
    path = scratch_folder(lines.sparkSession)
    (lines.repartition(_files(lines.sparkSession), "value").toDF(header)
     .write.csv(path, header=True, sep="\x01", quote="", escapeQuotes=False))
    return path


def _write_text(lines: DataFrame) -> str:
    path = scratch_folder(lines.sparkSession)
    lines.repartition(_files(lines.sparkSession), "value").write.text(path)
    return path


def respondent_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of CSV files of `respondents`, each with the header."""
    r = respondents(spark, sf_dir)
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in RESPONDENT_COLUMNS])
    return _write_csv(r.select(line.alias("value")), ",".join(RESPONDENT_COLUMNS))


def damaged_respondent_files(spark: SparkSession, sf_dir: str) -> str:
    """The same with bad lines, by the case number modulo `DAMAGE_CYCLE`: 1 a
    field short, 2 a field too many, 3 a blank age, 4 minutes that are no number."""
    r = respondents(spark, sf_dir)
    kind = F.col("tucaseid").cast("bigint") % DAMAGE_CYCLE
    text = {c: F.col(c).cast("string") for c in RESPONDENT_COLUMNS}
    text["t500101"] = F.when(kind != 1, text["t500101"])           # concat_ws leaves nulls out
    text["teage"] = F.when(kind == 3, F.lit("")).otherwise(text["teage"])
    text["t110101"] = F.when(kind == 4, F.lit("n/a")).otherwise(text["t110101"])
    line = F.concat_ws(",", *text.values(), F.when(kind == 2, F.lit("9")))
    return _write_csv(r.select(line.alias("value")), ",".join(RESPONDENT_COLUMNS))


def posting_files(spark: SparkSession, sf_dir: str) -> str:
    return _write_text(posting_lines(spark, sf_dir))


def article_files(spark: SparkSession, sf_dir: str) -> str:
    """Article lines; line breaks of the texts are spaces."""
    a = articles(spark, sf_dir)
    text = F.translate(F.coalesce("text", F.lit("")), "\r\n", "  ")
    return _write_text(a.select(article_line(F.col("title"), text).alias("value")))
